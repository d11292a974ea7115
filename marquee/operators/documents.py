"""Load-job operators: tag aggregation, search-document projection
(A4, J1, P13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.schemas import DOCUMENT_COLUMNS


def aggregate_tags(tags: DataFrame) -> DataFrame:
    """A4: distinct tags per movie joined with ``|`` in sorted order
    -> (mid, tags).  ``collect_set`` is partially aggregated map-side, so a
    hot movie costs one set of its *distinct* tags per task.  Movies whose
    tags are all null get NULL, not ''."""
    return (tags.groupBy("mid")
            .agg(F.nullif(F.concat_ws("|", F.array_sort(F.collect_set("tag"))), F.lit("")).alias("tags")))


def movie_documents(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """J1 + P13: every movie with its aggregated tags (untagged -> NULL), in
    the fixed 11-column order of the search documents."""
    agg = aggregate_tags(tags)
    return movies.join(agg, "mid", "left").select(*DOCUMENT_COLUMNS)
