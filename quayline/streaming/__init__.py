"""Incremental copies of growing datasets."""
