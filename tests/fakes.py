"""Small literal source relations for rule tests.

Every relation not given explicitly is empty, with the schema of the test
mapping's relation of the same name."""

from __future__ import annotations

from procura.sources.testdata import TestSources


class FakeSources:
    def __init__(self, spark, small_dir: str, **rows):
        self.spark = spark
        self._base = TestSources(spark, small_dir)
        self._rows = rows
        self._cache = {}

    def schema(self, name):
        from pyspark.sql.types import StructField, StructType
        s = getattr(self._base, name).schema
        return StructType([StructField(f.name, f.dataType, True) for f in s.fields])

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            schema = self.schema(name)
            data = self._rows.get(name, [])
            rows = [tuple(r.get(f.name) for f in schema.fields) if isinstance(r, dict) else r for r in data]
            self._cache[name] = self.spark.createDataFrame(rows, schema)
        return self._cache[name]
