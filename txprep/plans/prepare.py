"""The preparation job: raw transactions -> profile -> clean -> features ->
label-partitioned Parquet, with per-stage accounting.

Scans of the input: two, and one or two more with exact percentiles (the
default), whose histograms count the amounts around each rank. With adaptive
execution each shuffle of a scan is a Spark job of its own, so the job counter
shows more jobs than scans.

* pass 1 (one scan; per-task partial aggregates merged as a two-level
  tree): input rows, NULL profile, per-rule failures, validated rows and
  the KLL quantile sketch of validated amounts (``when(valid, amount)``);
* pass 2 (one scan with the validation and fence filters pushed to the
  reader, one shuffle on the key): one survivor per key, consistency,
  features (a projection), label-partitioned write. The stage 2-4 counts
  and the class split are ``observe``d in the write's result stage, where
  Spark applies each task's metrics once even when tasks are retried, so
  they cost no extra pass.

Nothing is cached or staged: a lost executor costs Spark's usual recompute
of its shuffle output, not a second copy of the data on storage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import LABEL_CLASSES, all_of, label_consistent, null_or_empty, validation_rules
from ..operators.cleaning import IQR_FACTOR, OUTLIER_PROBS, STAGES, clean, dedup, fence, in_bounds
from ..operators.features import add_features, select_ml_ready
from ..operators.partitioning import plan_partitions
from ..operators.profile import METRIC_SCHEMA
from ..operators.quantiles import bracket_probs, exact_quantiles, sketch_get, to_column_type, tree_agg
from ..schema import DEFAULT_COLUMNS, TX_SCHEMA, TxColumns
from ..sinks import refuse_overlap, write_partitioned
from ..sources import read_delimited, read_json, read_parquet


def ml_ready(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS, method: str = "exact",
             bounds: Row | None = None, deterministic: bool = True, min_rows: int = 0) -> DataFrame:
    """Lazy ML-ready table: clean -> features -> fixed columns."""
    cleaned = clean(df, cols, method=method, bounds=bounds, deterministic=deterministic, min_rows=min_rows)
    return select_ml_ready(add_features(cleaned, cols), cols)


@dataclass
class PrepareResult:
    output_path: str
    input_rows: int
    output_rows: int
    partitions: int
    bounds: dict
    waterfall: list = field(default_factory=list)      # (stage, step, rows)
    null_profile: dict = field(default_factory=dict)   # column -> nulls (input)
    clean_null_profile: dict = field(default_factory=dict)  # column -> nulls (cleaned rows)
    rule_failures: dict = field(default_factory=dict)  # rule -> failed rows
    class_counts: dict = field(default_factory=dict)   # label -> rows

    @property
    def retention_pct(self) -> float | None:
        return None if not self.input_rows else 100.0 * self.output_rows / self.input_rows

    def to_metrics(self, spark: SparkSession) -> DataFrame:
        """The job's accounting as metric rows (``section, item, metric,
        value, text``), for ``write_reports``. A fixed, small number of rows:
        one per stage, column, rule, class and bound."""
        rows = [("general", "", "input_rows", float(self.input_rows), None),
                ("general", "", "output_rows", float(self.output_rows), None),
                ("general", "", "retention_pct", self.retention_pct, None),
                ("general", "", "partitions", float(self.partitions), None),
                ("general", "", "output_path", None, self.output_path)]
        prev = None
        for stage, step, n in self.waterfall:
            rows.append(("waterfall", step, "rows", float(n), None))
            if prev is not None:
                rows.append(("waterfall", step, "removed", float(prev - n), None))
            prev = n
        for k, v in self.bounds.items():
            rows.append(("outlier_bounds", k, "value", None if v is None else float(v), None))
        rows += [("null_profile", c, "nulls", float(v), "input") for c, v in self.null_profile.items()]
        rows += [("null_profile", c, "nulls_clean", float(v), "cleaned") for c, v in self.clean_null_profile.items()]
        rows += [("rule_failures", r, "failed", float(v), None) for r, v in self.rule_failures.items()]
        total = sum(self.class_counts.values())
        for label, n in self.class_counts.items():
            rows.append(("class_distribution", f"class_{label}", "count", float(n), None))
            rows.append(("class_distribution", f"class_{label}", "percentage",
                         100.0 * n / total if total else None, None))
        return spark.createDataFrame(rows, METRIC_SCHEMA)


def _profile_pass(raw: DataFrame, cols: TxColumns, method: str, accuracy: int, rules: dict) -> tuple[Row, dict | None, tuple | None]:
    """All pass-1 numbers from one scan. With ``method="sketch"`` (and
    ``"exact"``, whose selection starts from this pass's sketch brackets) the
    counts and the amount sketch are combined per task group and then merged
    (no single task sees every task's sketch); with ``"approx"`` it is one
    global aggregation around ``percentile_approx``."""
    valid = F.coalesce(all_of(rules), F.lit(False))
    counts = {"rows": F.count(F.lit(1)), "valid": F.count_if(valid)}
    counts.update({f"n_{c}": F.count_if(null_or_empty(raw, c)) for c in raw.columns})
    counts.update({f"r_{i}": F.count_if(~F.coalesce(r, F.lit(False))) for i, r in enumerate(rules.values())})
    probs = [float(p) for p in OUTLIER_PROBS.values()]
    amount = F.when(valid, F.col(cols.amount))
    typ = raw.schema[cols.amount].dataType
    if method == "approx":
        row = raw.agg(*[c.alias(k) for k, c in counts.items()],
                      F.percentile_approx(amount, probs, accuracy).alias("q")).first()
        q = row["q"]
        return row, (dict(zip(OUTLIER_PROBS, q)) if q else None), None
    aggs = {k: (c, "sum") for k, c in counts.items()}
    aggs.update({"amin": (F.min(amount), "min"), "amax": (F.max(amount), "max")})
    brackets = bracket_probs(OUTLIER_PROBS, accuracy)
    has = F.col("valid") > 0
    # no input rows: no task groups, and sums over none are null
    row = tree_agg(raw, amount, typ, aggs).select(
        *[F.coalesce(k, F.lit(0)).alias(k) for k in counts], "amin", "amax", F.when(has, sketch_get(typ, probs)).alias("q"),
        F.when(has, sketch_get(typ, brackets)).alias("b")).first()
    q = None if not row["valid"] else [to_column_type(v, typ) for v in row["q"]]
    start = (row["valid"], row["amin"], row["amax"], row["b"] or [])
    return row, (dict(zip(OUTLIER_PROBS, q)) if q else None), start


SOURCE_FORMATS = ("delimited", "json", "parquet")


def read_source(spark: SparkSession, source, source_format: str = "delimited") -> DataFrame:
    """The raw input: a DataFrame as given, or path(s) read with the raw schema."""
    if not isinstance(source, (str, list)):
        return source
    if source_format == "delimited":
        return read_delimited(spark, source, TX_SCHEMA)
    if source_format == "json":
        return read_json(spark, source, TX_SCHEMA)
    if source_format == "parquet":
        return read_parquet(spark, source)
    raise ValueError(f"source_format must be one of {SOURCE_FORMATS}, not {source_format!r}")


def prepare(spark: SparkSession, source, output_path: str, cols: TxColumns = DEFAULT_COLUMNS,
            method: str = "exact", accuracy: int = 10000,
            max_output_partitions: int | None = None, source_format: str = "delimited",
            min_rows: int = 0, iqr_factor=IQR_FACTOR,
            label_classes: Sequence[int] = LABEL_CLASSES, rebalance: bool = False) -> PrepareResult:
    """Run the whole preparation job; ``source`` is a DataFrame or a path, glob
    or list of ``source_format`` files (delimited and JSON are read with the raw
    schema). The output may not overlap the input in any form: that is refused
    before anything is written. ``min_rows`` validated rows are needed for the
    fence (the reference: 1,000; default: always applied). ``rebalance`` deals the
    output by label before it is written, see ``write_partitioned``."""
    raw = read_source(spark, source, source_format)
    refuse_overlap(spark, raw, output_path, [source] if isinstance(source, str) else
                   source if isinstance(source, list) else [])
    typ = raw.schema[cols.amount].dataType
    rules = validation_rules(cols, label_classes)

    # pass 1: profile + rule failures + amount sketch, one scan
    p, q, start = _profile_pass(raw, cols, method, accuracy, rules)
    n_valid = int(p["valid"] or 0)
    if method == "exact":
        _, q = exact_quantiles(raw.filter(all_of(rules)), cols.amount, OUTLIER_PROBS, accuracy,
                               start=None if isinstance(typ, (T.DoubleType, T.FloatType)) else start)
    q = q or dict.fromkeys(OUTLIER_PROBS)
    one = spark.range(1).select(F.lit(n_valid).cast("bigint").alias("n"),
                                *[F.lit(q[k]).cast(typ).alias(k) for k in OUTLIER_PROBS])
    bounds = fence(one, typ, min_rows, iqr_factor).first()

    # pass 2: filters pushed to the scan, one shuffle on the key, one write
    fenced = raw.filter(all_of(rules))
    if bounds["applied"]:
        fenced = fenced.filter(in_bounds(bounds, cols, typ))
    keyed = dedup(fenced, cols.id, count_as="_dups")
    ok = F.coalesce(label_consistent(cols), F.lit(False))
    label = F.col(cols.label)
    obs = Observation("txprep_prepare_counts")
    keyed = keyed.observe(obs, F.sum("_dups").alias("s2"), F.count(F.lit(1)).alias("s3"),
                          F.count_if(ok).alias("s4"),
                          *[F.count_if(ok & (label == c)).alias(f"c_{i}") for i, c in enumerate(label_classes)],
                          *[F.count_if(ok & null_or_empty(raw, c)).alias(f"n_{c}") for c in raw.columns])
    out = select_ml_ready(add_features(keyed.filter(ok).select(*raw.columns), cols), cols)
    # sized before the write from the validated rows, an upper bound of the
    # output rows; coalesce only ever lowers the partition count
    k = plan_partitions(n_valid, max_partitions=max_output_partitions)
    write_partitioned(out, output_path, label=cols.label, partitions=k, rebalance=rebalance)
    counts = obs.get
    s2 = int(counts["s2"] or 0)
    rows_out = int(counts["s4"])

    names = list(rules)
    return PrepareResult(
        output_path=output_path, input_rows=int(p["rows"]), output_rows=rows_out, partitions=k,
        bounds=bounds.asDict(),
        waterfall=list(zip(range(5), STAGES, [int(p["rows"]), n_valid, s2, int(counts["s3"]), rows_out])),
        null_profile={c: int(p[f"n_{c}"]) for c in raw.columns},
        clean_null_profile={c: int(counts[f"n_{c}"]) for c in raw.columns},
        rule_failures={names[i]: int(p[f"r_{i}"]) for i in range(len(names))},
        class_counts={c: int(counts[f"c_{i}"]) for i, c in enumerate(label_classes)},
    )
