"""Writers, one module per storage form."""
