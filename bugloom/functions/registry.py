"""Functions for SQL: table functions parse_diff, diff_ranges, scan_text and place_sums."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators import diffs, scanners


@udtf(returnType="ord int, path string, body string, removed string")
class ParseDiff:
    def eval(self, diff: str, pull: bool):
        for k, found in enumerate((diffs.files_of_pull if pull else diffs.files_of_show)(diff)):
            yield k, *found


@udtf(returnType="file string, start int, end int")
class DiffRanges:
    def eval(self, diff: str):
        yield from diffs.ranges_of(diff or "")


@udtf(returnType="rule string, severity string, line int, message string")
class ScanText:
    """Findings of one rule, or of all active ones if the rule is null."""

    def eval(self, path: str, text: str, rule: str):
        for name in scanners.ACTIVE if rule is None else (rule,):
            severity, find = scanners.SCANNERS[name]
            for at, message in find(path or "", text or ""):
                yield name, severity, (text or "").count("\n", 0, at) + 1, message


@udtf
class PlaceSums:
    """The columns before a vector column, place (from 1), total and n: sums by place over a partition of a table argument.

    SELECT * FROM place_sums(TABLE(t) PARTITION BY (key, part), 'vector').  Its columns are those of the table: analyze tells
    them.  A partition's vectors pass one by one; sums of parts add up, so a large group is partitioned further.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, vector: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not isinstance(rows.dataType, StructType) or vector.value not in rows.dataType.names:
            raise ValueError("place_sums takes a table and the name of its vector column")
        keys = [f for f in rows.dataType.fields if f.name != vector.value]
        return AnalyzeResult(StructType([*keys, StructField("place", LongType()), StructField("total", DoubleType()), StructField("n", LongType())]))

    def __init__(self) -> None:
        self.key, self.total, self.n = None, np.zeros(0), np.zeros(0, np.int64)

    def eval(self, row, vector: str):
        values = row[vector]
        self.key = [row[f] for f in row.__fields__ if f != vector]
        if values is None:
            return
        if len(values) > len(self.total):
            more = len(values) - len(self.total)
            self.total, self.n = np.append(self.total, np.zeros(more)), np.append(self.n, np.zeros(more, np.int64))
        x = np.array(values, np.float64)  # a missing component is NaN
        there = ~np.isnan(x)
        self.total[: len(x)][there] += x[there]
        self.n[: len(x)] += there

    def terminate(self):
        for i, (total, n) in enumerate(zip(self.total.tolist(), self.n.tolist(), strict=True)):
            yield *self.key, i + 1, total, n


def register(spark: SparkSession) -> None:
    """SELECT f.* FROM files, LATERAL scan_text(path, text, NULL) f"""
    for name, f in (("parse_diff", ParseDiff), ("diff_ranges", DiffRanges), ("scan_text", ScanText), ("place_sums", PlaceSums)):
        spark.udtf.register(name, f)
