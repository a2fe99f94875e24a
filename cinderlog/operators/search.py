"""Search and filters over events or any table with a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cinderlog.functions import kept_apart, text as txt
from cinderlog.schema import LEVELS


def search(
    df: DataFrame, terms: Sequence[str], text: str = "message", mode: str = "all"
) -> DataFrame:
    """Rows whose text has all (or any) of the terms, with `score`, the number of hits.

    Only texts that hold the terms at all, if only as parts of words, are cut into words.
    """
    if not terms:
        raise ValueError("no search terms given")
    matches = {"all": txt.match_all, "any": txt.match_any}[mode]
    return (
        df.where(txt.may_match(text, terms, mode == "all"))
        .selectExpr("*", f"{kept_apart(txt.tokens(text))} AS _tokens")
        .where(matches("_tokens", terms))
        .selectExpr("*", f"{txt.match_count('_tokens', terms)} AS score")
        .drop("_tokens")
    )


def search_phrase(df: DataFrame, phrase: str, text: str = "message") -> DataFrame:
    """Rows whose text holds the words of the phrase one after another, in any letter case."""
    return (
        df.where(txt.may_match(text, [phrase], True))
        .selectExpr("*", f"{kept_apart(txt.tokens(text))} AS _tokens")
        .where(txt.match_phrase("_tokens", phrase))
        .drop("_tokens")
    )


def newest(df: DataFrame, k: int, time: str = "event_time", *ties: str) -> DataFrame:
    """The k newest rows; each task keeps k rows and the driver merges those."""
    return df.orderBy(F.col(time).desc(), *ties).limit(k)


def has_attribute(key: str, value: str | None = None) -> Column:
    def fits(a: Column) -> Column:
        same = a["key"] == key
        return same if value is None else same & (a["value"] == value)

    return F.exists("attributes", fits)


def for_client(df: DataFrame, client_id: str) -> DataFrame:
    """Rows of one client; on the landing folder, give the client to `read_landing` to list its folder alone."""
    return df.where(F.col("client_id") == client_id)


def filter_events(
    events: DataFrame,
    min_level: str | None = None,
    services: Sequence[str] | None = None,
    hosts: Sequence[str] | None = None,
    since: str | None = None,
    until: str | None = None,
    trace_id: str | None = None,
    attribute: tuple[str, str] | None = None,
) -> DataFrame:
    """Events that pass every given facet. `since` is included, `until` is not; both are UTC texts.

    All facets are plain predicates. On the index, times also prune folders by date.
    """
    kept = events
    if min_level is not None:
        kept = kept.where(F.col("level").isin(*LEVELS[LEVELS.index(min_level):]))
    if services is not None:
        kept = kept.where(F.col("service").isin(*services))
    if hosts is not None:
        kept = kept.where(F.col("host").isin(*hosts))
    for bound, after in ((since, True), (until, False)):
        if bound is None:
            continue
        moment = F.lit(bound).cast("timestamp")
        kept = kept.where(F.col("event_time") >= moment if after else F.col("event_time") < moment)
        if "event_date" in events.columns:
            day = F.to_date(moment)
            kept = kept.where(F.col("event_date") >= day if after else F.col("event_date") <= day)
    if trace_id is not None:
        kept = kept.where(F.col("trace_id") == trace_id)
    if attribute is not None:
        kept = kept.where(has_attribute(*attribute))
    return kept
