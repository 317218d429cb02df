"""Collection: candidates -> posts, post-keyword links, seen ids."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions.records import post_record
from postsieve.operators.arrivals import ARRIVAL, anti_seen, first_arrival, tested_first_seen
from postsieve.operators.keywords import expand_variants
from postsieve.operators.match import match_all
from postsieve.schemas import COUNTS, POSTS


class Collected(NamedTuple):
    posts: DataFrame
    """Matched post records with ``language`` and ``keyword_ids``."""
    seen: DataFrame
    """Ids of all new candidates, matched or not."""
    base: DataFrame
    """One row per new id, from which both are derived: persist it to use both."""


def one_per_id(candidates: DataFrame) -> DataFrame:
    """The first arrival of each id, by the arrival columns that are there."""
    order = [c for c in ["feed_seq", *ARRIVAL] if c in candidates.columns]
    return first_arrival(candidates, order=order)


def collect_all(
    candidates: DataFrame, keywords: DataFrame, seen: DataFrame, lemmas: DataFrame | None = None
) -> Collected:
    """Test every unseen post with every keyword, and with ``lemmas`` also with the
    plural and the lemma of each, under its id.

    Repeats are reduced to the first arrival before anything else: an id that
    arrives over and over leaves one row per task, and the shuffle places the
    posts by id.  The comparison with ``seen``, the match and its grouping go on in
    the same partitions.
    """
    if lemmas is not None:
        keywords = expand_variants(keywords, lemmas)
    unseen = anti_seen(one_per_id(candidates), seen)
    carry = ["text", "created_at", *COUNTS, "labels", "embed"]
    matched = match_all(unseen, keywords, text_col="text", carry=carry)
    record = post_record(matched).select(*POSTS.names, "keyword_ids")
    return Collected(record, unseen.select("external_id"), unseen)


def collect_first_seen(candidates: DataFrame, keywords: DataFrame, seen: DataFrame) -> Collected:
    """Test every unseen post only with the keyword that delivered it first.

    Candidates of a keyword that is not stored count as not delivered.
    """
    tested = tested_first_seen(candidates, keywords, seen)
    matched = tested.filter("is_match").withColumn("keyword_ids", F.array("keyword_id"))
    record = post_record(matched).select(*POSTS.names, "keyword_ids")
    return Collected(record, tested.select("external_id"), tested)
