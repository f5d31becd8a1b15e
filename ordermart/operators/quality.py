"""Data-quality suite.

Checks are declared on a :class:`QualitySuite` and evaluated lazily as one
small result DataFrame (check_name, passed, details):

* every row-level count (not-empty, nulls, null rates, expressions, values
  outside a domain, freshness) is one aggregate in **one** pass, fused with
  the first uniqueness check (group by its key, then a one-row merge);
* each further uniqueness check adds one grouped aggregate (one shuffle);
* all accepted-values checks together add one scan, whose bad values are
  counted per (check, value) before they meet;
* each relationship check adds one anti join.

:meth:`QualitySuite.measure` takes the row-level counts while the frame is being written
(an ``Observation`` on the write), so a gate needs no pass of its own for them. Only the result frame
(one row per check) is ever collected, by :meth:`QualitySuite.validate`.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermart.functions import fixed

log = logging.getLogger(__name__)


def _result(name: Column | str, passed: Column, details: Column) -> Column:
    nm = F.lit(name) if isinstance(name, str) else name
    return F.struct(nm.alias("check_name"), passed.alias("passed"), details.alias("details"))


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counts taken while it is written: (frame, observation). The observation
    must be the frame's last step, so it runs in the tasks that write: their counts are taken once each,
    whatever is retried before them."""
    seen = Observation()
    return df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(a) for a, c in counts.items()]), seen


def py_list_text(values: Column) -> Column:
    """Render an array<string> like a Python list: ['a', 'b']."""
    quoted = F.transform(values, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


@dataclass
class QualitySuite:
    df: DataFrame
    dataset_name: str
    _counts: list = field(default_factory=list)   # (alias, agg expr)
    _rows: list = field(default_factory=list)     # row builders over the main aggregate
    _extra: list = field(default_factory=list)    # separate one-row frames
    _unique: list = field(default_factory=list)   # column lists of uniqueness checks
    _accepted: list = field(default_factory=list)  # (column, allowed values)
    _measured: dict | None = None                 # row-level aggregates taken by measure()

    # -- declarations -----------------------------------------------------
    def _count(self, alias: str, expr: Column, combine: str = "sum") -> str:
        """Register a row-level aggregate; ``combine`` says how per-group
        partial values merge (``sum`` for counts, ``max`` for maxima)."""
        self._counts.append((alias, expr, combine))
        return alias

    def not_empty(self) -> "QualitySuite":
        n = self._count("_n", F.count(F.lit(1)))
        self._rows.append(lambda: _result("not_empty", F.col(n) > 0, F.format_string("row_count=%d", F.col(n))))
        return self

    def no_nulls(self, columns: Sequence[str]) -> "QualitySuite":
        for c in columns:
            a = self._count(f"_nulls_{c}", F.count_if(F.col(c).isNull()))
            self._rows.append(lambda c=c, a=a: _result(f"no_nulls:{c}", F.col(a) == 0, F.format_string("null_count=%d", F.col(a))))
        return self

    def null_rate(self, column: str, max_rate: float) -> "QualitySuite":
        n = self._count("_n", F.count(F.lit(1)))
        a = self._count(f"_nulls_{column}", F.count_if(F.col(column).isNull()))
        rate = F.when(F.col(n) > 0, F.col(a).cast("double") / F.col(n).cast("double")).otherwise(F.lit(0.0))
        self._rows.append(lambda: _result(
            f"null_rate:{column}", rate <= F.lit(max_rate),
            F.concat(F.lit("null_rate="), F.format_string("%.4f", F.round(rate, 4)), F.lit(f" threshold={max_rate}")),
        ))
        return self

    def expression_is_true(self, name: str, expr: str | Column) -> "QualitySuite":
        """Count rows where the expression is false (NULL passes)."""
        e = F.expr(expr) if isinstance(expr, str) else expr
        a = self._count(f"_false_{len(self._counts)}", F.count_if(~F.coalesce(e, F.lit(True))))
        self._rows.append(lambda: _result(f"expression_is_true:{name}", F.col(a) == 0, F.format_string("failing_rows=%d", F.col(a))))
        return self

    def unique(self, columns: Sequence[str]) -> "QualitySuite":
        """L4: total rows = distinct keys. The first uniqueness check of a
        suite is fused with the row-level aggregate (see :meth:`results`);
        further ones add one grouped aggregate each."""
        cols = list(columns)
        self._unique.append(cols)
        return self

    def _unique_row(self, cols: list[str], total: Column, distinct: Column) -> Column:
        return _result(
            "unique:" + ",".join(cols), total == distinct,
            F.format_string("total=%d distinct=%d dupes=%d", total, distinct, total - distinct),
        )

    def accepted_values(self, column: str, allowed: Sequence[str]) -> "QualitySuite":
        """NULL passes; details give the distinct bad values, all of them in sort order, or for
        gates their number (:meth:`results`), and the number of bad rows (:meth:`bad_values` has the values as rows)."""
        self._accepted.append((column, list(allowed)))
        return self

    def _accepted_frame(self, list_values: bool) -> DataFrame:
        """One row per accepted-values check, from one scan: each row's bad
        values become (check, value) pairs, counted per pair before they meet.
        Without ``list_values`` the details give the number of distinct values."""
        pairs = F.array(*[
            F.when(~F.col(c).isin(allowed), F.struct(F.lit(i).alias("check"), F.col(c).cast("string").alias("value")))
            for i, (c, allowed) in enumerate(self._accepted)])
        bad = (self.df.select(F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("p"))
               .groupBy("p.check", "p.value").agg(F.count("*").alias("rows")))
        checks = self.df.sparkSession.createDataFrame(
            [(i, f"accepted_values:{c}") for i, (c, _) in enumerate(self._accepted)], "check int, name string")
        values = F.array_sort(F.collect_list("value")) if list_values else F.count(F.lit(1))
        per_check = bad.groupBy("check").agg(F.sum("rows").alias("rows"), values.alias("values"))
        if list_values:
            found = F.concat(F.lit("invalid_values="), py_list_text(F.coalesce("values", F.array().cast("array<string>"))))
        else:
            found = F.format_string("distinct_invalid_values=%d", F.coalesce("values", F.lit(0)))
        text = F.concat(found, F.format_string(" invalid_rows=%d", F.coalesce("rows", F.lit(0))))
        return checks.join(per_check, "check", "left").select(_result(F.col("name"), F.col("rows").isNull(), text).alias("r"))

    def bad_values(self, column: str, allowed: Sequence[str]) -> DataFrame:
        """L5/D13 as rows: every value outside the domain and its number of rows."""
        value = F.col(column).cast("string").alias("value")
        return self.df.where(~F.col(column).isin(list(allowed))).groupBy(value).agg(F.count("*").alias("rows"))

    def volume(self, expected: int, tolerance: float = fixed.VOLUME_TOLERANCE) -> "QualitySuite":
        """|actual - expected| / max(expected, 1) <= tolerance."""
        n = self._count("_n", F.count(F.lit(1)))
        dev = F.abs(F.col(n) - F.lit(expected)).cast("double") / F.lit(float(max(expected, 1)))
        self._rows.append(lambda: _result(
            "volume_anomaly", dev <= F.lit(tolerance),
            F.concat(F.format_string("actual=%d expected=%d deviation=", F.col(n), F.lit(expected)),
                     F.format_string("%.2f", F.round(dev * 100, 2)), F.lit("%")),
        ))
        return self

    def freshness(self, column: str, as_of_ts: str,
                  warn_hours: float = fixed.FRESHNESS_WARN_HOURS,
                  error_hours: float = fixed.FRESHNESS_ERROR_HOURS) -> "QualitySuite":
        """Newest ``column`` older than warn / error hours."""
        a = self._count(f"_max_{column}", F.max(column), combine="max")
        age = (F.unix_micros(F.lit(as_of_ts).cast("timestamp")) - F.unix_micros(F.col(a))).cast("double") / 3.6e9
        status = F.when(F.col(a).isNull() | (age > error_hours), F.lit("error")).when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass"))
        self._rows.append(lambda: _result(
            f"freshness:{column}", status != "error",
            F.concat(F.lit("status="), status, F.lit(" age_hours="), F.format_string("%.2f", F.round(age, 2))),
        ))
        return self

    def relationships(self, column: str, parent: DataFrame, parent_column: str) -> "QualitySuite":
        """Every non-NULL child key exists in the parent."""
        self._extra.append(("relationships", column, parent, parent_column))
        return self

    def _relationship_frame(self, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
        # pre-aggregate child rows per key (map-side partial counts) so a hot
        # key is one row before the anti join; the parent side is its keys
        child = (self.df.select(F.col(column).alias("_k")).where(F.col("_k").isNotNull())
                 .groupBy("_k").agg(F.count(F.lit(1)).alias("_rows")))
        par = parent.select(F.col(parent_column).alias("_k"))
        orphans = child.join(par, "_k", "left_anti").agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("_o"), F.count(F.lit(1)).alias("_od"))
        return orphans.select(_result(
            f"relationships:{column}", F.col("_o") == 0,
            F.format_string("orphan_rows=%d orphan_keys=%d", F.col("_o"), F.col("_od")),
        ).alias("r"))

    # -- evaluation -------------------------------------------------------
    def _parts(self) -> list:
        return list({alias: (alias, expr, combine) for alias, expr, combine in self._counts}.values())

    def measure(self, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Run ``write``, which stores the frame and returns it as read back, and take the
        row-level aggregates on the way; the other checks read what was stored."""
        bad = [(f"_bad_{i}", F.count_if(~F.col(c).isin(allowed)), "sum") for i, (c, allowed) in enumerate(self._accepted)]
        seen = Observation()
        self.df = write(self.df.observe(seen, F.count(F.lit(1)).alias("_n"), *[e.alias(a) for a, e, _ in [*self._parts(), *bad] if a != "_n"]))
        self._measured = seen.get
        return self.df

    def results(self, list_values: bool = False) -> DataFrame:
        """All checks as one small frame. Row-level aggregates run in one
        pass (none after :meth:`measure`); with a uniqueness check that pass groups by its key first
        (map-side partial aggregation), so counts, totals and the distinct
        key count all come from one shuffle plus a one-row global merge.
        ``list_values`` puts every distinct bad value of a check into its details (one text a check); a
        gate's rows, which reach the driver, have their number."""
        parts = self._parts()
        frames: list[DataFrame] = []
        unique_rows, rest = [], self._unique
        if self._measured is not None:
            main = self.df.sparkSession.range(1).select(*[
                F.lit(self._measured[a]).cast("bigint" if c == "sum" else "timestamp").alias(a) for a, _, c in parts])
        elif self._unique:
            first, *rest = self._unique
            grouped = self.df.groupBy(*first).agg(
                F.count(F.lit(1)).alias("_gc"), *[e.alias(a) for a, e, _ in parts])
            merge = [F.coalesce(F.sum("_gc"), F.lit(0)).alias("_utotal"), F.count(F.lit(1)).alias("_udistinct")]
            merge += [(F.max(a) if c == "max" else F.coalesce(F.sum(a), F.lit(0))).alias(a) for a, _, c in parts]
            main = grouped.agg(*merge)
            unique_rows.append(self._unique_row(first, F.col("_utotal"), F.col("_udistinct")))
        else:
            main = self.df.agg(*[e.alias(a) for a, e, _ in parts]) if parts else None
        for cols in rest:
            per_key = self.df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
            agg = per_key.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_t"), F.count(F.lit(1)).alias("_d"))
            frames.append(agg.select(self._unique_row(cols, F.col("_t"), F.col("_d")).alias("r")))
        if self._rows or unique_rows:
            frames.append(main.select(F.explode(F.array(*[r() for r in self._rows], *unique_rows)).alias("r")))
        if self._accepted and self._measured is not None and not any(self._measured[f"_bad_{i}"] for i in range(len(self._accepted))):
            frames.append(self.df.sparkSession.range(1).select(F.explode(F.array(*[
                _result(f"accepted_values:{c}", F.lit(True), F.lit(("invalid_values=[]" if list_values else "distinct_invalid_values=0") + " invalid_rows=0"))
                for c, _ in self._accepted])).alias("r")))
        elif self._accepted:
            frames.append(self._accepted_frame(list_values))
        frames.extend(self._relationship_frame(*spec[1:]) for spec in self._extra)
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.select(F.lit(self.dataset_name).alias("dataset"), "r.check_name", "r.passed", "r.details")

    def validate(self, raise_on_failure: bool = True) -> list:
        """Collect the (small) result frame, log every check, raise
        listing the failed check names."""
        rows = self.results().collect()
        failed = [r for r in rows if not r["passed"]]
        for r in rows:
            (log.info if r["passed"] else log.error)(
                "[DQ] %s | %s | %s | %s", self.dataset_name, "PASS" if r["passed"] else "FAIL", r["check_name"], r["details"])
        if failed and raise_on_failure:
            raise ValueError(
                f"Data quality checks failed for '{self.dataset_name}': " + ", ".join(r["check_name"] for r in failed))
        return rows


def suite_from_specs(df: DataFrame, dataset_name: str, specs: Sequence[dict], parents: dict | None = None) -> QualitySuite:
    """Declarative suite. Each spec is a dict with ``test`` in
    not_null / unique / accepted_values / expression_is_true / null_rate /
    not_empty / relationships / freshness and its arguments."""
    s = QualitySuite(df, dataset_name)
    for spec in specs:
        t = spec["test"]
        if t == "not_empty":
            s.not_empty()
        elif t == "not_null":
            s.no_nulls([spec["column"]])
        elif t == "unique":
            s.unique(spec.get("columns") or [spec["column"]])
        elif t == "accepted_values":
            s.accepted_values(spec["column"], spec["values"])
        elif t == "expression_is_true":
            s.expression_is_true(spec.get("name", spec["column"]), f"{spec['column']} {spec['expression']}")
        elif t == "null_rate":
            s.null_rate(spec["column"], spec["max_rate"])
        elif t == "relationships":
            s.relationships(spec["column"], (parents or {})[spec["to"]], spec["field"])
        elif t == "freshness":
            s.freshness(spec["column"], spec["as_of"])
        else:
            raise ValueError(f"unknown test {t}")
    return s


def gate(df: DataFrame, suite: QualitySuite) -> DataFrame:
    """Run the suite before a write; returns the frame when every check
    passes, raises otherwise."""
    suite.validate(raise_on_failure=True)
    return df


def schema_conformance(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per expected or actual column: name, expected and actual
    type, its non-NULL rows (one aggregate over the table), passed."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = list(want) + [n for n in actual if n not in want]
    filled = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in actual])
    kind = "string"
    rows = F.array(*[F.struct(
        F.lit(n).alias("column_name"), F.lit(want.get(n)).cast(kind).alias("expected_type"),
        F.lit(actual.get(n)).cast(kind).alias("actual_type"),
        (F.col(f"`{n}`") if n in actual else F.lit(None)).cast("bigint").alias("non_null_rows"),
        F.lit(want.get(n) == actual.get(n)).alias("passed")) for n in names])
    return filled.select(F.explode(rows).alias("r")).select("r.*")


def reject_accounting(tagged: DataFrame, layer: str, reason: str = "_quarantine_reason") -> DataFrame:
    """input = valid + rejected, from one aggregate over the tagged
    frame both branches are filtered from."""
    return tagged.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col(reason).isNull()).alias("valid_rows"),
        F.count_if(F.col(reason).isNotNull()).alias("rejected_rows"),
    ).select(
        F.lit(layer).alias("layer"), "*",
        (F.col("input_rows") == F.col("valid_rows") + F.col("rejected_rows")).alias("balanced"),
    )


def volume_by_partition(df: DataFrame, partition_col: str, trailing: int = 7,
                        tolerance: float = fixed.VOLUME_TOLERANCE) -> DataFrame:
    """L6 without a supplied expectation: each partition's row count against
    the mean of the ``trailing`` earlier partitions (one row per partition,
    so the window is over a tiny frame)."""
    counts = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("actual"))
    w = Window.orderBy(partition_col).rowsBetween(-trailing, -1)
    exp = counts.withColumn("expected", F.round(F.avg("actual").over(w), 2))
    dev = F.abs(F.col("actual") - F.col("expected")) / F.greatest(F.col("expected"), F.lit(1.0))
    return exp.withColumn("deviation", F.round(dev, 4)).withColumn(
        "passed", F.coalesce(F.col("deviation") <= tolerance, F.lit(True)))


def volume_of_runs(runs: DataFrame, trailing: int = 7, tolerance: float = fixed.VOLUME_TOLERANCE) -> DataFrame:
    """L6 over the stored metrics of all runs (one row per layer and run): rows kept by each run
    against the mean of the ``trailing`` runs before it that passed their gate. The first
    run of a layer has nothing to be held against and passes."""
    w = Window.partitionBy("layer").orderBy("run_date").rowsBetween(Window.unboundedPreceding, -1)
    before = F.collect_list(F.when(F.col("passed"), F.col("kept_rows"))).over(w)  # one number a run
    last = F.slice(F.reverse(before), 1, trailing)
    expected = F.when(F.size(last) > 0, F.aggregate(last, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(last))
    out = runs.withColumn("expected", F.round(expected, 2))
    dev = F.abs(F.col("kept_rows") - F.col("expected")) / F.greatest(F.col("expected"), F.lit(1.0))
    return out.withColumn("deviation", F.round(dev, 4)).withColumn(
        "volume_passed", F.coalesce(F.col("deviation") <= tolerance, F.lit(True)))


def freshness_of_runs(runs: DataFrame, as_of_ts: str, warn_hours: float = fixed.FRESHNESS_WARN_HOURS,
                      error_hours: float = fixed.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """J8 from the stored measures of all runs: the newest event that each layer has taken, without a scan of its table."""
    newest = runs.groupBy("layer").agg(F.max("newest_ts_ms").alias("newest_ts_ms"))
    age = (F.unix_millis(F.lit(as_of_ts).cast("timestamp")) - F.col("newest_ts_ms")).cast("double") / 3.6e6
    return newest.select(
        "layer", F.timestamp_millis("newest_ts_ms").alias("newest_event"), F.round(age, 2).alias("age_hours"),
        F.when(F.col("newest_ts_ms").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def source_freshness(df: DataFrame, source: str, column: str, as_of_ts: str,
                     warn_hours: float = fixed.FRESHNESS_WARN_HOURS,
                     error_hours: float = fixed.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Newest load time of a source against ``as_of``: pass/warn/error."""
    agg = df.agg(F.max(column).alias("max_loaded_at"))
    age = (F.unix_micros(F.lit(as_of_ts).cast("timestamp")) - F.unix_micros(F.col("max_loaded_at"))).cast("double") / 3.6e9
    return agg.select(
        F.lit(source).alias("source"), "max_loaded_at",
        F.round(age, 2).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"),
    )
