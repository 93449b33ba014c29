"""Tables of cases with their participants, events and decision texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.html import DEFENDANT_ROLES, PLAINTIFF_ROLES
from docketlake.functions.text import blank, contains_any, inline, key_of, labelled_entry, safe_file_stem, strip, without_marker
from docketlake.operators.relational import first_per_key


def participants_pivot(people: DataFrame, case: str, role: str, name: str, order: str, plaintiffs=PLAINTIFF_ROLES, defendants=DEFENDANT_ROLES) -> DataFrame:
    """AG-20: the people of each case as three texts, in order; a name that is empty is the role."""
    r = F.coalesce(F.col(role), F.lit(""))
    n = F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(name)).otherwise(r)
    kind = F.when(contains_any(r, list(plaintiffs)), "p").when(contains_any(r, list(defendants)), "d").otherwise("o")
    rows = people.select(case, F.col(order).alias("_at"), kind.alias("_kind"), F.when(kind == "o", labelled_entry(r, n)).otherwise(n).alias("_text"))

    def joined(which: str) -> Column:
        held = F.array_sort(F.collect_list(F.when(F.col("_kind") == which, F.struct("_at", "_text"))))
        texts = F.transform(held, lambda x: x["_text"])
        return F.array_join(F.filter(texts, lambda x: x != "") if which == "o" else texts, "; ")

    return rows.groupBy(case).agg(joined("p").alias("participants_plaintiffs"), joined("d").alias("participants_defendants"), joined("o").alias("participants_other"))


def with_events(cases: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """J-13: a row for each event, the case's fields repeated; a case without events has one row with nulls."""
    return cases.join(events, key, "left")


def link_files(cases: DataFrame, link: str, number: str, order: str, folder: str = "opinion_fulltexts") -> DataFrame:
    """WN-2, J-3, SNK-9: ``link, path``: each link's file, named after the first case that has it."""
    rows = cases.where(~blank(F.col(link))).select(strip(F.col(link)).alias("link"), F.col(number).alias("_number"), F.col(order).alias("_order"))
    first = first_per_key(rows, ["link"], [F.col("_order")])
    return first.select("link", F.concat(F.lit(f"{folder}/"), safe_file_stem(F.col("_number")), F.lit("_"), key_of(F.col("link"), 8), F.lit(".txt")).alias("path"))


def with_texts(cases: DataFrame, texts: DataFrame, link: str, number: str, order: str) -> DataFrame:
    """J-2, SNK-10: the cases with ``opinion_text`` and ``opinion_text_file``, empty where a link has no text.

    ``texts``: ``url, opinion_text``, a row for each url.
    """
    known = texts.where("opinion_text is not null and opinion_text <> ''").select(F.col("url").alias("_url"), F.col("opinion_text").alias("_text"))
    files = link_files(cases, link, number, order).withColumnRenamed("link", "_link").withColumnRenamed("path", "_path")
    # Cases without a link ask for one that nothing has, a different one each, so that they do not meet in one task.
    own = F.coalesce(strip(F.col(link)), F.concat(F.lit("no link "), F.xxhash64(order, number).cast("string")))
    rows = cases.join(known, own == F.col("_url"), "left").join(files, own == F.col("_link"), "left")
    has = F.col("_text").isNotNull()
    rows = rows.withColumn("opinion_text", F.when(has, inline(F.col("_text"), F.col("_path"))).otherwise(F.lit("")))
    return rows.withColumn("opinion_text_file", F.when(has, F.col("_path")).otherwise(F.lit(""))).drop("_url", "_text", "_link", "_path")


def opinion_jobs(rows: DataFrame, files: DataFrame, path: str, cell: str) -> DataFrame:
    """J-12, S-17: the rows with ``opinion_id`` and ``body``: the file's text if it is there, else the cell's.

    ``files``: ``path, text``, a row for each file. The id is that of the path, or of the cell's first 500 characters
    without a truncation marker; rows with neither have nulls.
    """
    known = files.select(F.col("path").alias("_path"), F.col("text").alias("_text"))
    joined = rows.join(known, strip(F.col(path)) == F.col("_path"), "left")
    bare = F.when(~blank(F.col(cell)), without_marker(F.col(cell)))
    source = F.coalesce(F.col("_path"), F.substring(bare, 1, 500))
    body = F.when(F.col("_path").isNotNull(), F.col("_text")).otherwise(bare)
    return joined.withColumn("opinion_id", key_of(source)).withColumn("body", body).drop("_path", "_text")


def completion_counts(rows: DataFrame, text: str, complete: str) -> DataFrame:
    """AG-18, AG-21: rows, rows with a text, distinct texts, rows that are complete."""
    filled = F.coalesce(F.length(text) > 0, F.lit(False))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(filled).alias("with_text"),
        F.countDistinct(F.when(filled, F.sha1(text))).alias("distinct_texts"),
        F.count_if(F.coalesce(complete, F.lit(False))).alias("complete"),
    )
