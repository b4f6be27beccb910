"""Feature tables: column types, alignment, imputing, scaling and one-hot encoding."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.functions.order_statistics import medians, modes, select_ranks
from recordmill.functions.texts import stable_bucket
from recordmill.session import cut_lineage

# One-hot encoding keeps a column's categories in the model. More than this many is an
# error, never a silent cut.
MAX_CATEGORIES = 10_000


def require_column(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"Target column '{column}' not found. Available: {df.columns}")


def split_by_type(schema: T.StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and other columns, in order; booleans are not numeric."""
    fields = [f for f in schema if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def align(df: DataFrame, features: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """The feature columns in training order: missing ones NULL, extra ones dropped."""
    have = set(df.columns)
    columns = [(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in features.items()]
    return df.select(*[c for c in keep if c not in features], *columns)


def hash_split(df: DataFrame, key: str, train_share: float = 0.8) -> DataFrame:
    """Mark training rows by a hash of the row key, the same rows on every run."""
    return df.withColumn("is_train", stable_bucket(F.col(key)) % 100 < int(train_share * 100))


def stratified_split(df: DataFrame, key: str, label: str, train_share: float = 0.8) -> DataFrame:
    """Mark exactly ``floor(share * n)`` rows of each label as training rows.

    Rows are ordered by a 52-bit hash of their key and the cut is found as an order
    statistic, so no label's rows are sorted in one task.
    """
    position = stable_bucket(F.col(key), hex_digits=13).cast("double")

    def last_train(n: Column) -> tuple[Column, Column]:
        rank = F.floor(n * F.lit(float(train_share))) - 1
        return rank, rank

    placed = cut_lineage(df.select(label, position.alias("_position")))  # read for every narrowing of the cut
    found = select_ranks(placed, [label], F.col("_position"), last_train)
    cuts = cut_lineage(found.select(F.col(label).alias("_label"), F.col("low").alias("_cut")))
    marked = df.join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")
    return marked.withColumn("is_train", F.coalesce(position <= F.col("_cut"), F.lit(False))).drop("_label", "_cut")


@dataclass(frozen=True)
class Scaling:
    """What a numeric column's imputing and scaling needs."""

    column: str
    median: float
    mean: float
    deviation: float


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> list[Scaling]:
    """Exact median, then mean and population deviation of the filled column.

    NaN is no value. Columns without any value are left out; a constant column is divided by 1.
    """
    if not columns:
        return []
    df = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns})
    middle = {row["column"]: row["median"] for row in medians(df, columns).collect()}
    used = [c for c in columns if middle.get(c) is not None]
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(middle[c])) for c in used]
    if not used:
        return []
    row = df.agg(*[F.avg(f) for f in filled], *[F.stddev_pop(f) for f in filled]).first()
    return [Scaling(c, middle[c], row[i], row[len(used) + i] or 1.0) for i, c in enumerate(used)]


def scaled(scaling: Scaling) -> Column:
    filled = F.coalesce(F.nanvl(F.col(scaling.column).cast("double"), F.lit(None)), F.lit(scaling.median))
    return (filled - F.lit(scaling.mean)) / F.lit(scaling.deviation)


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value of each text column; columns without any value are left out."""
    if not columns:
        return {}
    found = {row["column"]: row["mode"] for row in modes(df, columns).collect()}
    return {c: found[c] for c in columns if c in found}


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def check_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> None:
    if not columns:
        return
    about = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(c) for c in columns]).first()
    wide = {c: about[c] for c in columns if about[c] > 2 * limit}
    close = [c for c in columns if limit / 2 < about[c] <= 2 * limit]
    if close and not wide:  # an estimate doesn't decide: these few values are counted
        counts = df.agg(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in close]).first()
        wide = {c: counts[c] for c in close if counts[c] > limit}
    if wide:
        raise ValueError(f"too many categories to one-hot encode: {wide}")


def preprocessing_stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], output: str) -> list:
    """Stages turning feature columns into one vector column.

    Numeric columns are filled with the median and scaled, others are filled with the
    most frequent value and one-hot encoded; a category not seen in training becomes all
    zeros. The learned figures are stored as literals of a SQL stage, so the fitted
    stages save and load like any other model.
    """
    check_categories(df, categorical)
    scalings = fit_scaling(df, numeric)
    fills = fit_modes(df, categorical)
    exprs = [
        f"(coalesce(nanvl(CAST({_sql_name(s.column)} AS DOUBLE), CAST(NULL AS DOUBLE)), {s.median!r}D) - ({s.mean!r}D)) / {s.deviation!r}D"
        f" AS {_sql_name('_num_' + s.column)}"
        for s in scalings
    ] + [
        f"coalesce(CAST({_sql_name(c)} AS STRING), {_sql_text(m)}) AS {_sql_name('_cat_' + c)}"
        for c, m in fills.items()
    ]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")]
    inputs = [f"_num_{s.column}" for s in scalings]
    if fills:
        filled = [f"_cat_{c}" for c in fills]
        indexed = [f"_idx_{c}" for c in fills]
        hot = [f"_hot_{c}" for c in fills]
        stages += [
            StringIndexer(inputCols=filled, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=output)]


def preprocess(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], output: str = "features") -> PipelineModel:
    """The fitted preprocessing stages."""
    return Pipeline(stages=preprocessing_stages(df, numeric, categorical, output)).fit(df)


def predict_with(
    df: DataFrame,
    model_fn: Callable[[], object],
    predict_fn: Callable,
    keys: Sequence[str],
    features: Sequence[str],
    prediction_type: str = "double",
) -> DataFrame:
    """Score with a model that is not a Spark one: ``keys, prediction``.

    ``model_fn`` loads it once per task, ``predict_fn(model, frame)`` returns one value
    per row of an Arrow-backed batch of the feature columns.
    """
    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], f"prediction {prediction_type}"])

    def score(batches):
        model = model_fn()
        for batch in batches:
            out = batch[list(keys)].copy()
            out["prediction"] = predict_fn(model, batch[list(features)])
            yield out

    return df.select(*dict.fromkeys([*keys, *features])).mapInPandas(score, schema)
