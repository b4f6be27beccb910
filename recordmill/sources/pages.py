"""Paged API payloads flattened to one row per record."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.variants import json_path, truthy
from recordmill.session import cut_lineage

# The accepted settings of a source.
PAGINATION_TYPES = ["none", "page", "offset", "cursor"]
AUTH_TYPES = ["none", "bearer", "api_key", "basic"]

RUN = ["source", "run_id"]
BUCKETS = 1_024  # of a run's page numbers, counted when the cap's page is looked for
BROADCAST_RUNS = 1_000_000  # rows of a run's name and one number; beyond that Spark chooses the join


@dataclass(frozen=True)
class SourceConfig:
    """How one source answers: where its records sit and how its pages end. ``max_pages`` None means no cap.

    Fixed values: the names of the settings and their defaults.
    """

    source_name: str
    base_url: str
    endpoint: str = "/"
    method: str = "GET"
    auth_type: str = "none"
    pagination_type: str = "none"
    page_size: int = 100
    max_pages: int | None = 50
    cursor_field: str = "next_cursor"
    records_json_path: str = "data"

    @classmethod
    def from_mapping(cls, given: Mapping[str, Any]) -> "SourceConfig":
        """Take the known settings; the two required ones must be there."""
        missing = [k for k in ("source_name", "base_url") if k not in given]
        if missing:
            raise ValueError(f"source config lacks {', '.join(missing)}")
        known = {f.name: given[f.name] for f in fields(cls) if f.name in given}
        known["base_url"] = str(known["base_url"]).rstrip("/")
        for key in ("page_size", "max_pages"):
            if key in known and (key == "page_size" or known[key] is not None):
                known[key] = int(known[key])
        if known.get("pagination_type", "none") not in PAGINATION_TYPES:
            raise ValueError(f"pagination_type must be one of {PAGINATION_TYPES}")
        if known.get("auth_type", "none") not in AUTH_TYPES:
            raise ValueError(f"auth_type must be one of {AUTH_TYPES}")
        return cls(**known)


def _with_settings(pages: DataFrame, configs: Sequence[SourceConfig]) -> DataFrame:
    """Pages of the known sources with their source's settings, which travel as literals."""
    entries: list[Column] = []
    for c in configs:
        settings = {
            "kind": c.pagination_type,
            "page_size": c.page_size,
            "max_pages": F.lit(c.max_pages).cast("long"),
            "cursor_path": json_path(c.cursor_field, nested=False),
            "records_path": json_path(c.records_json_path),
            "records_name": c.records_json_path,
        }
        entries += [F.lit(c.source_name), F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in settings.items()])]
    known = pages.where(F.col("source").isin([c.source_name for c in configs]))
    return known.withColumn("_s", F.element_at(F.create_map(*entries), F.col("source")))


def _records(payload: Column) -> Column:
    """The array at the source's records path, NULL when there is none."""
    return F.try_variant_get(payload, F.col("_s.records_path"), "array<variant>")


class PagedRuns:
    """The pages ``source, run_id, page_no, payload`` of the known sources, and what a reader would have asked for.

    What is kept of every page is its key and whether its run ends there. Records are read from
    the payloads of the pages that count, so no page's records are written for nothing.

    A run ends with the first page after which nothing more is asked for, or at the cap.
    The first is a minimum over narrow rows. The cap matters only to runs that have more
    pages than it before their end; the page it falls on is found by counting page numbers
    in ranges, so no run is ever sorted or gathered, however long and whatever the cap.
    """

    def __init__(self, pages: DataFrame, configs: Iterable[SourceConfig]):
        configs = list(configs)
        known = pages.where(F.col("source").isin([c.source_name for c in configs]))
        for key in ("run_id", "page_no"):
            known = known.withColumn(key, F.coalesce(key, F.raise_error(F.lit(f"a page has no {key}")).cast(pages.schema[key].dataType)))
        self.configs, self.pages = configs, known.select(*RUN, "page_no", "payload")
        self.narrow = cut_lineage(_ends(_with_settings(known, configs)))
        self._runs: DataFrame | None = None

    def _few(self, runs: DataFrame) -> DataFrame:
        return F.broadcast(runs) if runs.count() <= BROADCAST_RUNS else runs

    def runs(self) -> DataFrame:
        """Per run ``stop`` (its ending page, if one came), ``n`` (pages up to there), ``first``, ``last``, ``max_pages``."""
        if self._runs is not None:
            return self._runs
        stops = cut_lineage(self.narrow.where("is_last").groupBy(*RUN).agg(F.min("page_no").alias("stop")))
        with_stop = self.narrow.select(*RUN, "page_no").join(self._few(stops), RUN, "left").where("stop IS NULL OR page_no <= stop")
        per_run = with_stop.groupBy(*RUN).agg(
            F.min("stop").alias("stop"), F.count(F.lit(1)).alias("n"), F.min("page_no").alias("first"), F.max("page_no").alias("last")
        )
        self._runs = cut_lineage(_with_settings(per_run, self.configs).withColumn("max_pages", F.col("_s.max_pages")).drop("_s"))
        return self._runs

    def limits(self, runs: DataFrame) -> DataFrame:
        """Per run the last page that counts, NULL for a run that neither a page nor the cap ends."""
        long = runs.where("n > max_pages")
        capped = None if long.isEmpty() else self._page_at(long)
        ends = runs.select(*RUN, "stop")
        if capped is None:
            return ends.withColumnRenamed("stop", "limit")
        return ends.join(capped, RUN, "left").select(*RUN, F.least("stop", "capped").alias("limit"))

    def _page_at(self, long: DataFrame) -> DataFrame:
        """The ``max_pages``-th page number of each of these runs, by counts of ever smaller ranges of numbers."""
        ranges = cut_lineage(long.select(*RUN, F.col("first").alias("low"), F.col("last").alias("high"), F.col("max_pages").alias("need")))
        while True:
            width = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low") + 1) / BUCKETS)).cast("long")
            inside = self.narrow.select(*RUN, "page_no").join(self._few(ranges.withColumn("width", width)), RUN).where("page_no BETWEEN low AND high")
            bucket = F.floor((F.col("page_no") - F.col("low")) / F.col("width")).cast("long")
            counts = inside.groupBy(*RUN, "low", "need", "width", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
            listed = counts.groupBy(*RUN, "low", "need", "width").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("told"))
            start = F.struct(F.col("need").alias("need"), F.lit(-1).cast("long").alias("bucket"))
            crossed = F.aggregate(
                "told",
                start,
                lambda at, told: F.when(at["bucket"] >= 0, at)
                .when(at["need"] <= told["n"], F.struct(at["need"].alias("need"), told["bucket"].alias("bucket")))
                .otherwise(F.struct((at["need"] - told["n"]).alias("need"), at["bucket"].alias("bucket"))),
            )
            low = F.col("low") + F.col("at.bucket") * F.col("width")
            found = listed.withColumn("at", crossed).select(*RUN, low.alias("low"), (low + F.col("width") - 1).alias("high"), F.col("at.need").alias("need"))
            ranges = cut_lineage(found)
            if ranges.where("high > low").isEmpty():
                return ranges.select(*RUN, F.col("low").alias("capped"))

    def kept(self) -> DataFrame:
        """The pages that count, as they came. The semi join can broadcast only the narrow limits, never payloads."""
        limits = self._few(self.limits(self.runs()).select(*[F.col(c).alias(f"_{c}") for c in (*RUN, "limit")]))
        here = [F.col(c) == F.col(f"_{c}") for c in RUN]
        within = F.col("_limit").isNull() | (F.col("page_no") <= F.col("_limit"))
        return self.pages.join(limits, [*here, within], "left_semi")

    def records(self) -> DataFrame:
        """One row per record of the pages that count: ``source, run_id, page_no, position, data``.

        A page whose records are not a list fails the job; pages that do not count are not looked at.
        """
        found = _with_settings(self.kept(), self.configs)
        complaint = F.concat(F.lit("Expected list at '"), F.col("_s.records_name"), F.lit("'"))
        records = F.coalesce(_records(F.parse_json("payload")), F.raise_error(complaint).cast("array<variant>"))
        return found.select(*RUN, "page_no", F.posexplode(records).alias("position", "data"))

    def cut(self) -> DataFrame:
        """Runs that ``max_pages`` ended before a page did: ``source, run_id, max_pages``."""
        over = "n > max_pages OR (stop IS NULL AND n >= max_pages)"
        return self.runs().where(over).select(*RUN, "max_pages")


def _ends(pages: DataFrame) -> DataFrame:
    """Pages and whether their run asks for no more after them: ``source, run_id, page_no, is_last``.

    A source without paging ends at its first page whatever that holds, so its pages are not parsed here.
    """
    kind = F.col("_s.kind")
    stop = (
        (kind == "none")
        | (F.col("n_records") == 0)
        | (kind.isin("page", "offset") & (F.col("n_records") < F.col("_s.page_size")))
        | ((kind == "cursor") & ~truthy(F.col("cursor")))
    )
    return (
        pages.withColumn("payload_v", F.when(kind != "none", F.try_parse_json("payload")))
        .withColumn("cursor", F.when(kind == "cursor", F.try_variant_get("payload_v", F.col("_s.cursor_path"), "variant")))
        .withColumn("n_records", F.array_size(_records(F.col("payload_v"))))
        .select(*RUN, F.col("page_no").cast("long").alias("page_no"), F.coalesce(stop, F.lit(False)).alias("is_last"))
    )


def kept_pages(pages: DataFrame, configs: Iterable[SourceConfig]) -> DataFrame:
    """The pages a reader following the stop rules would have asked for: ``source, run_id, page_no``."""
    return PagedRuns(pages, configs).kept().select(*RUN, "page_no")


def cut_runs(pages: DataFrame, configs: Iterable[SourceConfig]) -> DataFrame:
    """Runs that ``max_pages`` ended before a page did: ``source, run_id, max_pages``."""
    return PagedRuns(pages, configs).cut()


def flatten_pages(pages: DataFrame, configs: Iterable[SourceConfig]) -> DataFrame:
    """Rows ``source, run_id, page_no, payload`` to one row per record: ``source, run_id, page_no, position, data``."""
    return PagedRuns(pages, configs).records()


def page_gaps(pages: DataFrame, configs: Iterable[SourceConfig] = ()) -> DataFrame:
    """Runs whose pages are not all there, told by their keys: ``source, run_id, expected, present, stray``.

    The keys of a run are 1, 2, 3 .. or, for a source paged by offset, 0, page_size, twice
    that and so on up to the largest one seen. ``present`` counts those that are there,
    ``stray`` different ones that are no such key.
    """
    steps = [(F.col("source") == c.source_name, c.page_size) for c in configs if c.pagination_type == "offset"]
    step, first = F.lit(1).cast("long"), F.lit(1).cast("long")
    for mine, size in steps:
        step, first = F.when(mine, F.lit(size).cast("long")).otherwise(step), F.when(mine, F.lit(0).cast("long")).otherwise(first)
    keys = pages.select(*RUN, F.col("page_no").cast("long").alias("page_no")).where("page_no IS NOT NULL").distinct()
    placed = keys.withColumn("at", F.col("page_no") - first).withColumn("step", step)
    good = (F.col("at") >= 0) & (F.col("at") % F.col("step") == 0)
    told = placed.groupBy(*RUN, "step").agg(F.max(F.when(good, F.col("at"))).alias("last"), F.count_if(good).alias("present"), F.count_if(~good).alias("stray"))
    expected = F.coalesce((F.col("last") / F.col("step")).cast("long") + 1, F.lit(0).cast("long"))
    return told.select(*RUN, expected.alias("expected"), "present", "stray").where("expected <> present OR stray > 0")


def next_request(config: SourceConfig, params: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The first request's paging parameters; the caller's own values win."""
    first: dict[str, Any] = {}
    if config.pagination_type == "page":
        first = {"page": 1, "per_page": config.page_size}
    elif config.pagination_type == "offset":
        first = {"offset": 0, "limit": config.page_size}
    return {**first, **dict(params or {})}


def page_key(config: SourceConfig, page_rank: Column) -> Column:
    """The page number or offset the n-th request of a run carries."""
    if config.pagination_type == "offset":
        return (page_rank - 1) * config.page_size
    return page_rank
