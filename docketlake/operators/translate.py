"""Translation through an injected translator: distinct values, verified batches, a cache that outlives runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import CYRILLIC, looks_untranslated, needs_translation
from docketlake.operators.corpus import DELIMITER, MAX_CHARS, _alone, packed_sizes, paragraph_chunks, segments_of, sentence_pieces
from docketlake.session import settled, ship

#: Text in, text out; raises or returns nothing on failure. It must be picklable: it runs on the executors.
Translator = Callable[[str], str | None]
COLUMN_CHARS = 4500


def attempt(translator: Translator, text: str, tries: int = 3) -> str | None:
    """TR-2: the translation, or None after so many failures; an empty answer is a failure."""
    for _ in range(tries):
        try:
            answer = translator(text)
        except Exception:  # noqa: BLE001 - a translator may raise anything; that is a failed try
            continue
        if answer and answer.strip():
            return answer
    return None


def translate_paragraph(translator: Translator, norm: str, limit: int = MAX_CHARS) -> str | None:
    """TR-3: a paragraph over the limit goes in pieces, all or nothing."""
    if len(norm) <= limit:
        return attempt(translator, norm)
    parts = [attempt(translator, piece) for piece in sentence_pieces(norm, limit)]
    return None if None in parts else " ".join(parts)


def translate_batch(translator: Translator, paragraphs: Sequence[str], limit: int = MAX_CHARS) -> list[str | None]:
    """TR-4: one call for all; if the answer has another number of segments, a call for each."""
    whole = segments_of(attempt(translator, DELIMITER.join(paragraphs))) if len(paragraphs) > 1 else []
    return whole if whole and len(whole) == len(paragraphs) else [translate_paragraph(translator, p, limit) for p in paragraphs]


def translate_document(translator: Translator, text: str, limit: int = MAX_CHARS) -> tuple[str, bool]:
    """TR-7: a whole text chunk by chunk; a chunk that fails stays as it is, and the text does not count as done."""
    chunks = paragraph_chunks(text, limit)
    answers = [attempt(translator, c) for c in chunks]
    return "\n".join(a if a is not None else c for a, c in zip(answers, chunks, strict=True)), None not in answers


def translate_documents(docs: DataFrame, translator: Translator, doc: str = "doc_id", text: str = "text", limit: int = MAX_CHARS) -> DataFrame:
    """TR-7 on a table: ``doc, en, complete``; a null or blank text has no translation and counts as complete. Computed once."""
    ship(docs.sparkSession)

    def run(frames):
        for frame in frames:
            done = [translate_document(translator, t, limit) if t is not None and t.strip() else (None, True) for t in frame["_text"]]
            yield pd.DataFrame({"_doc": frame["_doc"], "en": [en for en, _ in done], "complete": [ok for _, ok in done]})

    rows = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    found = rows.mapInPandas(run, f"_doc {docs.schema[doc].dataType.simpleString()}, en string, complete boolean")
    return settled(found.withColumnRenamed("_doc", doc))


def check_translator(translator: Translator, sample: str = "тест") -> None:
    """TR-6: fails before any work if the translator does not answer."""
    if attempt(translator, sample) is None:
        raise RuntimeError("the translator does not answer")


def translate_values(values: DataFrame, translator: Translator, column: str = "value", pattern: str | None = CYRILLIC) -> DataFrame:
    """TR-1, O-1, O-6: ``value, en`` for each distinct value; what needs no translation, or fails, is its own.

    A value over COLUMN_CHARS goes in pieces of up to so many characters, all or nothing.
    """
    ship(values.sparkSession)

    @F.pandas_udf("string")
    def translated(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: translate_paragraph(translator, t, COLUMN_CHARS))

    distinct = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    wanted = needs_translation(F.col("value"), pattern)
    done = distinct.where(wanted).select("value", F.coalesce(translated.asNondeterministic()("value"), F.col("value")).alias("en"))
    return settled(done.union(distinct.where(~wanted).select("value", F.col("value").alias("en"))))


def translate_pending(paragraphs: DataFrame, cache: DataFrame, translator: Translator, order: list[str], limit: int = MAX_CHARS) -> DataFrame:
    """O-2, O-3, O-4, O-5: ``k, ru, en`` of the paragraphs ``k, norm`` that the cache lacks and that could be translated.

    What is missing is found once. Packed into batches over all partitions, by their lengths alone; each batch is one call, to which its texts are
    joined by key. The result is computed once, so that no plan asks the translator again.
    """
    ship(paragraphs.sparkSession)
    missing = settled(paragraphs.join(cache.select("k"), "k", "left_anti").select(*dict.fromkeys(["k", "norm", *order])))
    sizes = missing.select("k", *[c for c in order if c != "k"], F.length("norm").cast("long").alias("_length"), _alone("norm", limit).alias("_alone"))
    packed = packed_sizes(sizes, order, limit).select("k", "batch_id", "batch_pos")
    whole = packed.join(missing.select("k", "norm"), "k")
    batches = whole.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("batch_pos", "k", "norm"))).alias("items"))

    def run(frames):
        for frame in frames:
            rows = []
            for items in frame["items"]:
                answers = translate_batch(translator, [x["norm"] for x in items], limit)
                rows += [(x["k"], x["norm"], en) for x, en in zip(items, answers, strict=True) if en is not None]
            yield pd.DataFrame(rows, columns=["k", "ru", "en"])

    return settled(batches.select("items").mapInPandas(run, "k string, ru string, en string"))


def without_untranslated(cache: DataFrame, pattern: str = CYRILLIC, limit: float = 0.30) -> DataFrame:
    """TR-8: the cache without entries that are still mostly in the source's letters."""
    return cache.where(~looks_untranslated(F.col("en"), pattern, limit))
