"""News: landed pages to raw articles, pending articles to published ones.

Links are compared without the texts: what is new or pending is found on (link, date) alone, and the texts of those links are then
read from their months.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.operators.dedup import first_wins_wide, not_in
from candlehouse.operators.transform import transform_news
from candlehouse.plans.ingest import PAGE_ROWS, staged, store_rejects
from candlehouse.plans.storage import append_new, periods_of, write_partitioned
from candlehouse.schemas import LINK_SCHEMA, NEWS_RAW_SCHEMA, NEWS_SCHEMA
from candlehouse.sources import payloads as P
from candlehouse.sources.tables import PERIOD, conform, read_table, with_period

LINK = ["link", "published_date"]


@dataclass(frozen=True)
class NewsStore:
    """Raw and published articles, by month, and the ledger of links already transformed."""

    spark: SparkSession
    root: str

    @property
    def raw_path(self) -> str:
        return f"{self.root}/news_articles_raw"

    @property
    def published_path(self) -> str:
        return f"{self.root}/news_articles"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/news_transformed_links"

    @property
    def reject_path(self) -> str:
        return f"{self.root}/rejects"

    def raw(self) -> DataFrame:
        return read_table(self.spark, self.raw_path, with_period(NEWS_RAW_SCHEMA))

    def published(self) -> DataFrame:
        return read_table(self.spark, self.published_path, with_period(NEWS_SCHEMA)).drop(PERIOD)

    def ledger(self) -> DataFrame:
        return read_table(self.spark, self.ledger_path, LINK_SCHEMA)


def _append_by_link(articles: DataFrame, known: DataFrame, path: str) -> int:
    """Append the articles whose link is not among ``known`` links."""
    new = not_in(articles.select("link"), known.select("link"), ["link"])
    rows = articles.join(new, "link", "left_semi").withColumn(PERIOD, C.trade_period(F.col("published_date")))
    return write_partitioned(rows, path, ["link"], counts=[F.count("*").alias("n")])["n"]


def save_articles(store: NewsStore, articles: DataFrame) -> int:
    """Append articles (unique by link) whose link is not stored yet."""
    return _append_by_link(conform(articles, NEWS_RAW_SCHEMA), store.raw(), store.raw_path)


def ingest_news(store: NewsStore, payloads: DataFrame) -> dict:
    """Landed pages (page, payload) to raw articles; of equal links the first by page and place. Bad rows go to the reject table."""
    with staged(P.parse_news(payloads), store.raw_path) as rows:
        good = P.valid(rows.filter("NOT rejected").drop("rejected"))
        ordered = good.withColumn("_arrival", F.col("page").cast("bigint") * F.lit(PAGE_ROWS).cast("bigint") + F.col("pos"))
        stored = save_articles(store, first_wins_wide(ordered, ["link"], "_arrival"))
        rejected = store_rejects(rows.filter("rejected").drop("rejected"), "news", store.reject_path)
    return {"stored": stored, "rejected": rejected}


def pending_links(store: NewsStore) -> DataFrame:
    """Link and date of the raw articles that no transform run has seen."""
    return not_in(store.raw().select(*LINK), store.ledger(), ["link"])


def pending_articles(store: NewsStore, links: DataFrame | None = None) -> DataFrame:
    """The raw articles that no transform run has seen, from the months of their links."""
    links = pending_links(store) if links is None else links
    months = store.raw().filter(F.col(PERIOD).isin(periods_of(links, "published_date")))
    return months.join(links.select("link"), "link", "left_semi").drop(PERIOD)


def transform_pending(store: NewsStore) -> None:
    """Publish the pending articles that are not blank and mark all pending ones as done.

    Published rows are inserted by link, and the ledger is written last: a run that
    dies in between is repeated without publishing an article twice.
    """
    links = pending_links(store)
    fresh = conform(transform_news(pending_articles(store, links), keep=["link"]), NEWS_SCHEMA)
    _append_by_link(fresh, store.published(), store.published_path)
    append_new(conform(links, LINK_SCHEMA), store.ledger_path, ["link"])


def news_round(store: NewsStore, payloads: DataFrame) -> dict:
    """One fetch-and-transform round over landed pages."""
    counts = ingest_news(store, payloads)
    transform_pending(store)
    return counts
