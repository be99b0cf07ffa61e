"""Dataset catalog on top of Spark's: external tables with properties."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.errors import InvalidParameterError, MissingFieldError
from quayline.functions.literal import quote_ident, quote_text
from quayline.operators.filters import check_name
from quayline.refs import DATASET_TYPES, CsvFormat
from quayline.session import configure
from quayline.sources.csv import read_csv
from quayline.types import Column, as_columns, declared_schema

_PREFIX = "dataset."
# Descriptor entries kept as table properties.
FIELDS = ("name", "type", "source_id", "relative_uri", "vendor", "file_format")
_KEPT = (*FIELDS, "location", "columns", "csv")


class DatasetCatalog:
    """Create, query, update and delete dataset metadata; files stay on delete."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark = configure(spark)
        self.database = database

    def _table(self, dataset_id: str) -> str:
        return f"{quote_ident(self.database)}.{quote_ident(check_name(dataset_id, 'dataset id'))}"

    def create(
        self, dataset_id: str, location: str, file_format: str, columns=None, csv: CsvFormat | None = None, **fields
    ) -> None:
        """Register a dataset that lies at ``location``."""
        if fields.get("type", "table") not in DATASET_TYPES:
            raise InvalidParameterError(f"unknown dataset type {fields['type']!r}")
        source, options = file_format, {}
        if file_format == "csv":
            csv = csv or CsvFormat()
            options = {**csv.dialect(), "header": str(csv.header).lower()}
            if csv.encoding:
                options["encoding"] = csv.encoding
        elif file_format == "binary":
            source = "binaryFile"
        schema = declared_schema(columns) if columns else None
        self.spark.catalog.createTable(self._table(dataset_id), location, source, schema, **options)
        kept = {"file_format": file_format, "location": location}
        if csv:
            kept["csv"] = json.dumps(asdict(csv))
        if columns:
            kept["columns"] = json.dumps([[c.name, c.type] for c in as_columns(columns)])
        self._set(dataset_id, {"type": "table", **fields, **kept})

    def _set(self, dataset_id: str, fields: dict[str, str]) -> None:
        unknown = [f for f in fields if f not in _KEPT]
        if unknown:
            raise InvalidParameterError(f"unknown dataset field: {', '.join(unknown)}")
        pairs = ", ".join(f"{quote_text(_PREFIX + k)} = {quote_text(str(v))}" for k, v in fields.items())
        self.spark.sql(f"ALTER TABLE {self._table(dataset_id)} SET TBLPROPERTIES ({pairs})")

    def exists(self, dataset_id: str) -> bool:
        return self.spark.catalog.tableExists(self._table(dataset_id))

    def get(self, dataset_id: str) -> dict[str, str]:
        """The registered fields of a dataset."""
        if not self.exists(dataset_id):
            raise MissingFieldError(f"no dataset {dataset_id!r}")
        rows = (
            self.spark.sql(f"SHOW TBLPROPERTIES {self._table(dataset_id)}")
            .where(F.col("key").startswith(_PREFIX))
            .collect()
        )
        return {r["key"][len(_PREFIX):]: r["value"] for r in rows}

    def update(self, dataset_id: str, **fields) -> None:
        self.get(dataset_id)
        fixed = [f for f in fields if f in ("location", "columns", "csv", "file_format")]
        if fixed:
            raise InvalidParameterError(f"cannot change {', '.join(fixed)} of a registered dataset")
        self._set(dataset_id, fields)

    def delete(self, dataset_id: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(dataset_id)}")

    def ids(self) -> list[str]:
        """Registered datasets of this database."""
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def read(self, dataset_id: str) -> DataFrame:
        """The dataset's rows; declared CSV types are converted as in any CSV read."""
        known = self.get(dataset_id)
        if known["file_format"] == "csv":
            columns = [Column(*c) for c in json.loads(known.get("columns", "[]"))]
            return read_csv(self.spark, known["location"], columns, fmt=CsvFormat(**json.loads(known["csv"])))
        return self.spark.table(self._table(dataset_id))
