"""Queries over texts. An opinion is a document; letters stand in for Cyrillic, which the test documents lack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions import text as T
from docketlake.operators import corpus as C
from docketlake.operators import relational as R
from docketlake.operators.assembly import Assembly
from docketlake.operators.cases import completion_counts, link_files, participants_pivot, with_events, with_texts
from docketlake.operators.cases import opinion_jobs as jobs_of
from docketlake.operators.translate import translate_pending, translate_values
from docketlake.session import settled, shared_folder
from docketlake.sources.readers import table

LETTERS = "[A-Za-z]"
#: RE2's white space as ``functions.text`` means it.
W = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.lines_of(table(spark, sf, "documents").select("doc_id", "text"), pattern=LETTERS)


LINES = f"""raw AS (SELECT doc_id, unnest(range(0, len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
normed AS (SELECT *, regexp_replace(regexp_replace(line, '{W}+', ' ', 'g'), '^ | $', '', 'g') AS x FROM raw),
lines AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, line, CASE WHEN regexp_matches(x, '{LETTERS}') THEN x END AS norm, CASE WHEN regexp_matches(x, '{LETTERS}') THEN substr(sha1(x), 1, 16) END AS k FROM normed)"""


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select("doc_id", "pos", "norm", "k")


def paragraph_unique(spark: SparkSession, sf: str) -> DataFrame:
    return C.unique_paragraphs(_lines(spark, sf))


def paragraph_stats(spark: SparkSession, sf: str) -> DataFrame:
    return C.paragraph_stats(_lines(spark, sf))


def paragraph_keys(spark: SparkSession, sf: str) -> DataFrame:
    return C.keys_of_documents(_lines(spark, sf)).select("doc_id", F.size("keys").cast("long").alias("n_keys"), F.array_join("keys", ",").alias("keys"))


def _cache(spark: SparkSession, sf: str, share: str) -> DataFrame:
    """Paragraphs in lower case as their translations, for a share of the keys."""
    return C.unique_paragraphs(_lines(spark, sf)).where(share).select("k", F.lower("norm").alias("en"))


def reassemble_identity(spark: SparkSession, sf: str) -> DataFrame:
    """With nothing translated and no gate each document comes back as it was."""
    none = spark.createDataFrame([], "k string, en string")
    return C.reassembled(_lines(spark, sf), none, gate=False)


def reassemble_complete(spark: SparkSession, sf: str) -> DataFrame:
    return C.reassembled(_lines(spark, sf), _cache(spark, sf, "k >= '08'"))


def reassemble_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The same in three steps: documents with nothing to translate, then each half of the cache touches only what it completes."""
    assembly = Assembly(spark, shared_folder(spark, "assembly"), buckets=16)
    done = assembly.begin(_lines(spark, sf)).withColumn("step", F.lit(0))
    cache = settled(_cache(spark, sf, "k >= '08'"))
    for step, part in enumerate(("k < '8'", "k >= '8'"), 1):
        done = done.unionByName(assembly.add(cache.where(part), str(step)).withColumn("step", F.lit(step)))
    return done.unionByName(assembly.incomplete().select("doc_id"), allowMissingColumns=True)


def pack_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All distinct paragraphs, packed in the order of first appearance."""
    rows = C.unique_paragraphs(_lines(spark, sf)).select("k", "norm", "first_doc", "first_pos")
    return C.pack_batches(rows, ["first_doc", "first_pos", "k"]).select("k", "batch_id", "batch_pos")


def sentence_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return C.chunked(table(spark, sf, "documents"))


def paragraph_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return C.chunked(table(spark, sf, "documents"), by="paragraph")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(C.sentences_of(F.col("text"))).alias("pos", "sentence"))


def batch_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of each document joined with the delimiter and split again."""
    lines = F.filter(F.transform(F.split("text", "\n"), T.collapse), lambda x: x != "")
    rows = table(spark, sf, "documents").select("doc_id", lines.alias("l"))
    back = C.split_batch(C.joined_batch(F.col("l")))
    return rows.select("doc_id", F.size("l").alias("n"), (F.size(back) == F.size("l")).alias("same_count"))


def inline_truncate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    path = F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select("doc_id", T.inline(F.col("text"), path, limit=2000, kept=1900).alias("cell"))


def marker_strip(spark: SparkSession, sf: str) -> DataFrame:
    cells = inline_truncate(spark, sf)
    return cells.select("doc_id", T.without_marker(F.col("cell")).alias("text"))


def letter_ratio(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.round(T.share_of(F.col("text"), "[aeiou]"), 9).alias("share"), T.looks_untranslated(F.col("text"), "[aeiou]").alias("over"))


def duplicate_documents_first(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct text at the first document that has it."""
    docs = table(spark, sf, "documents").select("doc_id", T.key_of(F.col("text")).alias("k"))
    return R.first_per_key(docs, ["k"], [F.col("doc_id")])


def first_appearance(spark: SparkSession, sf: str) -> DataFrame:
    return R.first_seen(table(spark, sf, "documents"), F.col("source"), F.col("doc_id"), "source")


def first_n_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of the first ten documents only."""
    lines = _lines(spark, sf)
    first = R.first_n(table(spark, sf, "documents").select("doc_id"), [F.col("doc_id")], 10)
    keys = lines.join(first, "doc_id", "left_semi").where("k is not null").select("k").distinct()
    return lines.where("k is not null").select("doc_id", "pos", "k").join(keys, "k", "left_semi")


def pending_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    return R.pending(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


def retry_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of bad quality count as errors that are tried again."""
    done = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 0, "no_text_found").alias("error"))
    return R.pending(table(spark, sf, "documents").select("doc_id"), done, "doc_id", retry_failures=True)


def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("quality").isNull(), "pending").when(F.col("quality") == 0, "failed").otherwise("fetched")
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def distinct_translatable(spark: SparkSession, sf: str) -> DataFrame:
    values = R.distinct_values(table(spark, sf, "part"), ["p_brand", "p_type"])
    return values.where(T.needs_translation(F.col("value"), LETTERS))


def needs_translation(spark: SparkSession, sf: str) -> DataFrame:
    """Names, dates, times, numbers, links and blanks."""
    given = F.expr("CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN ' 01.02.2025 ' WHEN 2 THEN '12:30' WHEN 3 THEN '2-10' WHEN 4 THEN 'http://x.example' ELSE '  ' END")
    rows = table(spark, sf, "part").select("p_partkey", given.alias("given"))
    return rows.select("p_partkey", "given", T.needs_translation(F.col("given"), LETTERS).alias("needed"))


def translated_left_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.createDataFrame([("Brand#11", "first"), ("Brand#22", "second"), ("Brand#33", "third")], "value string, en string")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return R.with_lookup(parts.withColumnRenamed("p_brand", "value"), rows, "value", "en", "brand_en", F.col("value"))


def translated_values(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct types through a translator that writes them backwards."""
    return translate_values(table(spark, sf, "part"), _backwards, "p_type", LETTERS)


def _backwards(text: str) -> str:
    return text[::-1]


def _whispered(text: str) -> str:
    return text.lower()


def translated_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct paragraph in batches through a translator that whispers: the cache is empty.

    Without blanks: pieces of a paragraph over the limit come back joined by one, wherever it was cut.
    """
    unique = C.unique_paragraphs(_lines(spark, sf)).select("k", "norm", "first_doc", "first_pos")
    done = translate_pending(unique, spark.createDataFrame([], "k string, en string"), _whispered, ["first_doc", "first_pos", "k"])
    return done.select("k", "ru", F.replace("en", F.lit(" "), F.lit("")).alias("en_without_blanks"))


def sanitize_filename(spark: SparkSession, sf: str) -> DataFrame:
    given = F.concat(F.lit("  "), F.col("p_name"), F.lit(" / ~ М-"), F.col("p_partkey").cast("string"), F.lit("/2026 ~"))
    rows = table(spark, sf, "part").select("p_partkey", given.alias("given"))
    return rows.select("p_partkey", T.safe_file_stem(F.col("given"), 24).alias("stem"), T.safe_name(F.col("given")).alias("name"))


WORDS = ("Жуков", "ЩЕДРЫЙ", "объезд", "Ёлка-палка", "Abc Юла", "чай", "Амвросиевский")


def transliterate(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in WORDS])
    rows = table(spark, sf, "supplier").select("s_suppkey", F.get(words, (F.col("s_suppkey") % len(WORDS)).cast("int")).alias("word"))
    return rows.select("s_suppkey", "word", T.transliterate(F.col("word")).alias("latin"), T.court_name(F.col("word")).alias("name"))


LATIN_OF = {"Жуков": ("Zhukov", "Zhukov"), "ЩЕДРЫЙ": ("ShchEDRYI", "ShchEDRYI"), "объезд": ("obezd", "obezd"), "Ёлка-палка": ("Elka-palka", "Elka-palka"), "Abc Юла": ("Abc Yula", "Abc"), "чай": ("chai", "chai"), "Амвросиевский": ("Amvrosievskii", "Amvrosievskii")}


def shorten_label(spark: SparkSession, sf: str) -> DataFrame:
    labels = {"1-URGENT": "urgent", "5-LOW": "low"}
    rows = table(spark, sf, "orders")
    return rows.select("o_orderkey", T.shorten(F.col("o_orderpriority"), labels).alias("label"))


def column_widths(spark: SparkSession, sf: str) -> DataFrame:
    return R.widths(table(spark, sf, "part").select("p_name", "p_brand", "p_type"))


def participants(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as people, whole texts as their names."""
    people = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.col("text").alias("name"))
    return participants_pivot(people, "conv_id", "role", "name", "turn", plaintiffs=("user",), defendants=("assistant",))


def case_events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their conversations of the same number as events."""
    cases = table(spark, sf, "documents").select(F.col("doc_id").alias("case"), "source")
    events = table(spark, sf, "conversations").select(F.col("conv_id").alias("case"), "turn", F.col("role").alias("event_name"))
    return with_events(cases, events, "case")


def _linked_documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every document is a case and a text; links are null, unmatched, shared by up to three cases, or the one of document 1."""
    docs = table(spark, sf, "documents")
    i = F.col("doc_id")
    n = F.when(i % 11 == 1, F.lit("1")).when(i % 7 == 3, F.concat(F.lit("x"), i.cast("string"))).otherwise((i - i % 3).cast("string"))
    link = F.concat(F.lit(" https://court.example/doc?n="), n, F.lit(" "))
    cases = docs.select("doc_id", F.concat(F.lit("2-"), i.cast("string"), F.lit("/2026")).alias("case_number"), F.when(i % 5 != 0, link).alias("judicial_acts_link"))
    texts = docs.select(F.concat(F.lit("https://court.example/doc?n="), i.cast("string")).alias("url"), F.col("text").alias("opinion_text"))
    return cases, texts


def opinions_of_cases(spark: SparkSession, sf: str) -> DataFrame:
    cases, texts = _linked_documents(spark, sf)
    rows = with_texts(cases, texts, "judicial_acts_link", "case_number", "doc_id")
    return rows.select("doc_id", F.length("opinion_text").alias("chars"), "opinion_text_file")


def opinion_files(spark: SparkSession, sf: str) -> DataFrame:
    return link_files(_linked_documents(spark, sf)[0], "judicial_acts_link", "case_number", "doc_id")


def opinion_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Each third document has a file, each third a cell only, and the others a file that is not there."""
    docs = table(spark, sf, "documents")
    path = F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = docs.where("doc_id % 3 = 0").select(path.alias("path"), "text")
    cell = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("[TRUNCATED -- x]\n"), F.col("text")))
    rows = docs.select("doc_id", F.when(F.col("doc_id") % 3 != 1, path).alias("file"), cell.alias("cell"))
    return jobs_of(rows, files, "file", "cell").select("doc_id", "opinion_id", F.length("body").alias("chars"))


def completion(spark: SparkSession, sf: str) -> DataFrame:
    done = C.reassembled(_lines(spark, sf), _cache(spark, sf, "k >= '08'"))
    return completion_counts(done, "text", "complete")


QUERIES = {
    f.__name__: f
    for f in (
        paragraphs, paragraph_unique, paragraph_stats, paragraph_keys, reassemble_identity, reassemble_complete, reassemble_in_steps, pack_batches,
        sentence_chunks, paragraph_chunks, sentences, batch_round_trip, inline_truncate, marker_strip, letter_ratio,
        duplicate_documents_first, first_appearance, first_n_semi_join, pending_anti_join, retry_failures, run_counters,
        distinct_translatable, needs_translation, translated_left_join, translated_values, translated_paragraphs,
        sanitize_filename, transliterate, shorten_label, column_widths, participants, case_events, opinions_of_cases, opinion_files, opinion_jobs, completion,
    )
}

U = "SELECT k, min(norm) AS norm, count(*) AS occurrences, arg_min(doc_id, (doc_id, pos)) AS first_doc, arg_min(pos, (doc_id, pos)) AS first_pos FROM lines WHERE k IS NOT NULL GROUP BY k"
CELL = "CASE WHEN length(text) > 2000 THEN '[TRUNCATED -- full text in texts/' || doc_id || '.txt]' || chr(10) || substr(text, 1, 1900) ELSE text END"
GIVEN = "'  ' || p_name || ' / ~ М-' || p_partkey || '/2026 ~'"
LINKED = "l AS (SELECT doc_id, '2-' || doc_id || '/2026' AS case_number, CASE WHEN doc_id % 5 <> 0 THEN 'https://court.example/doc?n=' || CASE WHEN doc_id % 11 = 1 THEN '1' WHEN doc_id % 7 = 3 THEN 'x' || doc_id ELSE CAST(doc_id - doc_id % 3 AS VARCHAR) END END AS link FROM documents), f AS (SELECT link, 'opinion_fulltexts/' || regexp_replace(arg_min(case_number, doc_id), '[^\\p{L}\\p{N}_-]+', '_', 'g') || '_' || substr(sha1(link), 1, 8) || '.txt' AS path FROM l WHERE link IS NOT NULL GROUP BY link)"
STRIP = f"regexp_replace(%s, '^{W}+|{W}+$', '', 'g')"

#: Sentences of every document: an end mark, then white space as Java's and Python's patterns have it (RE2's lacks \\x0B).
ENDS = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"


def _sentences_of(rows: str, space: str) -> str:
    """``d, i, s``: the sentences of ``rows`` (``d, text``); a mark that no text has stands where one ends."""
    return f"SELECT d, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS s FROM (SELECT d, string_split(regexp_replace(text, '([.!?]){space}+', '\\1' || chr(57344), 'g'), chr(57344)) AS l FROM {rows} WHERE text IS NOT NULL)"


def _packed(units: str, glue: str, stripped: bool, limit: int = C.MAX_CHARS) -> str:
    """A fold over ``units`` (``d, i, x, apart``): pieces ``d, pos, piece`` of at most ``limit`` characters, in order.

    ``apart`` is 1 for a unit that begins a piece, 2 for one that is a piece by itself. With ``stripped`` pieces have no white
    space at their ends, but for one that follows a full piece.
    """
    strip = lambda c: f"regexp_replace({c}, '^{W}+|{W}+$', '', 'g')" if stripped else c
    joined = strip(f"r.piece || {glue} || u.x")
    alone = f"CASE WHEN u.apart = 2 THEN u.x ELSE {strip('u.x')} END"
    full = f"(r.piece <> '' AND (r.apart = 2 OR u.apart > 0 OR length({joined}) > {limit}))"
    return f"""r AS (
  SELECT d, 0 AS i, '' AS piece, 0 AS apart, NULL::VARCHAR AS gone, max(i) AS n FROM {units} GROUP BY d
  UNION ALL
  SELECT r.d, u.i, CASE WHEN r.piece = '' OR r.apart = 2 OR u.apart > 0 THEN {alone} WHEN length({joined}) > {limit} THEN u.x ELSE {joined} END, u.apart, CASE WHEN {full} THEN r.piece END, r.n
  FROM r JOIN {units} u ON u.d = r.d AND u.i = r.i + 1
), out AS (SELECT d, i, gone AS piece FROM r WHERE gone IS NOT NULL UNION ALL SELECT d, i + 1, piece FROM r WHERE i = n AND piece <> '')"""


def _cut(rows: str, limit: int = C.MAX_CHARS) -> str:
    """Units of sentences ``d, i, s``: one over the limit in parts, which begin pieces and, but for the last, are pieces."""
    return f"""(SELECT d, row_number() OVER (PARTITION BY d ORDER BY i, j) AS i, substr(s, j * {limit} + 1, {limit}) AS x, CASE WHEN length(s) <= {limit} THEN 0 WHEN (j + 1) * {limit} < length(s) THEN 2 ELSE 1 END AS apart
  FROM (SELECT d, i, s, unnest(range(0, greatest(CAST(ceil(length(s) / {limit}.0) AS BIGINT), 1))) AS j FROM {rows}))"""


POSITIONS = "SELECT d AS doc_id, CAST(row_number() OVER (PARTITION BY d ORDER BY i) - 1 AS INTEGER) AS pos, piece AS chunk FROM"
DOCS = "docs AS (SELECT doc_id AS d, text FROM documents)"
#: Sentence pieces of lines over the limit are units of their own; they and other lines are packed by line ends.
PARAGRAPHS = f"""WITH RECURSIVE lines AS (SELECT doc_id * 1000000 + ln AS d, doc_id, ln, line AS text FROM (SELECT doc_id, unnest(range(0, len(l))) AS ln, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
longer AS (SELECT d, text FROM lines WHERE length(text) > {C.MAX_CHARS}), s AS ({_sentences_of('longer', ENDS)}), u AS ({_cut('s')}), {_packed('u', "' '", True)},
units AS (SELECT doc_id AS d, row_number() OVER (PARTITION BY doc_id ORDER BY ln, j) AS i, x, apart FROM (
  SELECT doc_id, ln, 0 AS j, text AS x, 0 AS apart FROM lines WHERE length(text) <= {C.MAX_CHARS} UNION ALL SELECT doc_id, ln, out.i, piece, 2 FROM out JOIN lines USING (d))),
{_packed('units', 'chr(10)', False).replace('r AS (', 'q AS (', 1).replace('FROM r JOIN', 'FROM q r JOIN').replace('out AS (', 'chunks AS (', 1).replace('FROM r WHERE', 'FROM q WHERE')}
{POSITIONS} chunks"""

#: The batch that each paragraph begins if it begins one; those that do are reached from the first by doubling steps.
FAR = f"""items AS (SELECT k, norm, row_number() OVER (ORDER BY first_doc, first_pos, k) AS i, length(norm) AS n, length(norm) > {C.MAX_CHARS} OR regexp_matches(norm, '@{{3,}}') AS alone FROM u),
sums AS (SELECT *, sum(n + {len(C.DELIMITER)}) OVER (ORDER BY i) AS c, coalesce(min(CASE WHEN alone THEN i END) OVER (ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), (SELECT count(*) + 1 FROM u)) AS stop FROM items),
j0 AS MATERIALIZED (SELECT a.i, CASE WHEN a.alone THEN a.i + 1 ELSE least(b.i + 1, a.stop) END AS t FROM sums a ASOF JOIN sums b ON a.c - a.n - {len(C.DELIMITER)} + {C.MAX_CHARS + len(C.DELIMITER)} >= b.c),
s0 AS MATERIALIZED (SELECT 1 AS i WHERE EXISTS (SELECT 1 FROM u))"""
for _step in range(24):
    FAR += f""",
s{_step + 1} AS MATERIALIZED (SELECT i FROM s{_step} UNION SELECT t FROM s{_step} JOIN j{_step} USING (i)), j{_step + 1} AS MATERIALIZED (SELECT a.i, b.t FROM j{_step} a JOIN j{_step} b ON a.t = b.i)"""

ORACLE_SQL = {
    "sentences": f"WITH {DOCS}, s AS ({_sentences_of('docs', '[ \\t\\n\\x0B\\f\\r]')}) SELECT d AS doc_id, CAST(i - 1 AS INTEGER) AS pos, s AS sentence FROM s",
    "sentence_chunks": f"WITH RECURSIVE {DOCS}, s AS ({_sentences_of('docs', ENDS)}), u AS ({_cut('s')}), {_packed('u', "' '", True)} {POSITIONS} out",
    "paragraph_chunks": PARAGRAPHS,
    "pack_batches": f"WITH {LINES}, u AS ({U}), {FAR} SELECT k, CAST(dense_rank() OVER (ORDER BY b) - 1 AS BIGINT) AS batch_id, CAST(i - b AS BIGINT) AS batch_pos FROM (SELECT items.k, items.i, s24.i AS b FROM items ASOF JOIN s24 ON items.i >= s24.i)",
    "paragraphs": f"WITH {LINES} SELECT doc_id, pos, norm, k FROM lines",
    "paragraph_unique": f"WITH {LINES} {U}",
    "paragraph_stats": f"WITH {LINES}, u AS ({U}) SELECT count(DISTINCT doc_id) AS documents, count(*) AS lines, count(k) AS occurrences, CAST(coalesce(sum(length(norm)), 0) AS BIGINT) AS chars, (SELECT count(*) FROM u) AS unique_paragraphs, (SELECT CAST(coalesce(sum(length(norm)), 0) AS BIGINT) FROM u) AS unique_chars FROM lines",
    "paragraph_keys": f"WITH {LINES} SELECT doc_id, count(DISTINCT k) AS n_keys, coalesce(string_agg(DISTINCT k, ',' ORDER BY k), '') AS keys FROM lines GROUP BY doc_id",
    "reassemble_identity": f"WITH {LINES} SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, bool_and(norm IS NULL) AS complete FROM lines GROUP BY doc_id",
    "reassemble_complete": f"WITH {LINES}, d AS (SELECT doc_id, string_agg(CASE WHEN norm IS NULL THEN line ELSE lower(norm) END, chr(10) ORDER BY pos) AS text, bool_and(norm IS NULL OR k >= '08') AS complete FROM lines GROUP BY doc_id) SELECT doc_id, CASE WHEN complete THEN text END AS text, complete FROM d",
    "reassemble_in_steps": f"WITH {LINES}, d AS (SELECT doc_id, string_agg(CASE WHEN norm IS NULL THEN line ELSE lower(norm) END, chr(10) ORDER BY pos) AS text, max(CASE WHEN k IS NULL THEN 0 WHEN k < '08' THEN 3 WHEN k < '8' THEN 1 ELSE 2 END) AS s FROM lines GROUP BY doc_id) SELECT doc_id, CASE WHEN s < 3 THEN text END AS text, CASE WHEN s < 3 THEN CAST(s AS INTEGER) END AS step FROM d",
    "batch_round_trip": f"WITH {LINES} SELECT doc_id, CAST(count(*) FILTER (WHERE x <> '') AS INTEGER) AS n, true AS same_count FROM normed GROUP BY doc_id",
    "inline_truncate": f"SELECT doc_id, {CELL} AS cell FROM documents",
    "marker_strip": f"SELECT doc_id, regexp_replace({STRIP % f'({CELL})'}, '^\\[TRUNCATED[^\\]]*\\]\\n', '') AS text FROM documents",
    "letter_ratio": "WITH r AS (SELECT doc_id, (length(text) - length(regexp_replace(text, '[aeiou]', '', 'g')))::DOUBLE / greatest(length(text), 1) AS s FROM documents) SELECT doc_id, round(s, 9) AS share, s > 0.3 AS over FROM r",
    "duplicate_documents_first": "SELECT min(doc_id) AS doc_id, substr(sha1(text), 1, 16) AS k FROM documents GROUP BY 2",
    "first_appearance": "SELECT source, min(doc_id) AS first_seen FROM documents GROUP BY 1",
    "first_n_semi_join": f"WITH {LINES} SELECT doc_id, pos, k FROM lines WHERE k IN (SELECT k FROM lines WHERE k IS NOT NULL AND doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10))",
    "pending_anti_join": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "retry_failures": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (quality <> 0 OR quality IS NULL))",
    "run_counters": "SELECT CASE WHEN quality IS NULL THEN 'pending' WHEN quality = 0 THEN 'failed' ELSE 'fetched' END AS status, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "distinct_translatable": f"SELECT DISTINCT value FROM (SELECT p_brand AS value FROM part UNION SELECT p_type FROM part) WHERE regexp_matches(value, '{LETTERS}') AND NOT starts_with(value, 'http')",
    "needs_translation": f"WITH g AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN ' 01.02.2025 ' WHEN 2 THEN '12:30' WHEN 3 THEN '2-10' WHEN 4 THEN 'http://x.example' ELSE '  ' END AS given FROM part) SELECT p_partkey, given, regexp_matches(given, '{LETTERS}') AND NOT starts_with(trim(given), 'http') AND NOT regexp_full_match(trim(given), '\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}|\\d{{2}}:\\d{{2}}|[\\d-]+') AS needed FROM g",
    "translated_left_join": "SELECT p_partkey, p_brand AS value, CASE p_brand WHEN 'Brand#11' THEN 'first' WHEN 'Brand#22' THEN 'second' WHEN 'Brand#33' THEN 'third' ELSE p_brand END AS brand_en FROM part",
    "translated_values": f"SELECT DISTINCT p_type AS value, CASE WHEN regexp_matches(p_type, '{LETTERS}') THEN reverse(p_type) ELSE p_type END AS en FROM part",
    "translated_paragraphs": f"WITH {LINES}, u AS ({U}) SELECT k, norm AS ru, replace(lower(norm), ' ', '') AS en_without_blanks FROM u",
    "sanitize_filename": f"SELECT p_partkey, substr(regexp_replace(regexp_replace({GIVEN}, '[^\\p{{L}}\\p{{N}}_-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 24) AS stem, regexp_replace(regexp_replace({GIVEN}, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM part",
    "transliterate": "WITH w(i, word, latin, name) AS (VALUES " + ", ".join(f"({i}, '{w}', '{LATIN_OF[w][0]}', '{LATIN_OF[w][1]}')" for i, w in enumerate(WORDS)) + f") SELECT s_suppkey, word, latin, name FROM supplier JOIN w ON s_suppkey % {len(WORDS)} = i",
    "shorten_label": "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS label FROM orders",
    "column_widths": """WITH w AS (SELECT 'p_name' AS "column", max(length(p_name)) AS n FROM part UNION ALL SELECT 'p_brand', max(length(p_brand)) FROM part UNION ALL SELECT 'p_type', max(length(p_type)) FROM part) SELECT "column", CAST(least(greatest(greatest(n, length("column")) + 2, 12), 55) AS INTEGER) AS width FROM w""",
    "participants": """WITH p AS (SELECT conv_id, turn, coalesce(role, '') AS role, CASE WHEN text <> '' THEN text ELSE coalesce(role, '') END AS name FROM conversations)
SELECT conv_id, coalesce(string_agg(name, '; ' ORDER BY turn, name) FILTER (WHERE contains(lower(role), 'user')), '') AS participants_plaintiffs,
  coalesce(string_agg(name, '; ' ORDER BY turn, name) FILTER (WHERE contains(lower(role), 'assistant') AND NOT contains(lower(role), 'user')), '') AS participants_defendants,
  coalesce(string_agg(CASE WHEN role <> '' AND role <> name THEN role || ': ' || name ELSE name END, '; ' ORDER BY turn, name) FILTER (WHERE NOT contains(lower(role), 'assistant') AND NOT contains(lower(role), 'user')), '') AS participants_other
FROM p GROUP BY conv_id""",
    "case_events": "SELECT doc_id AS case, source, turn, role AS event_name FROM documents LEFT JOIN conversations ON conv_id = doc_id",
    "opinions_of_cases": f"WITH {LINKED}, t AS (SELECT 'https://court.example/doc?n=' || doc_id AS url, text FROM documents WHERE text <> '') SELECT doc_id, CAST(coalesce(CASE WHEN length(text) > 32000 THEN length('[TRUNCATED -- full text in ' || path || ']') + 1 + 31900 ELSE length(text) END, 0) AS INTEGER) AS chars, CASE WHEN text IS NULL THEN '' ELSE path END AS opinion_text_file FROM l LEFT JOIN t ON l.link = t.url LEFT JOIN f ON l.link = f.link",
    "opinion_jobs": f"WITH b AS (SELECT doc_id, text, regexp_replace({STRIP % "('[TRUNCATED -- x]' || chr(10) || text)"}, '^\\[TRUNCATED[^\\]]*\\]\\n', '') AS bare FROM documents) SELECT doc_id, substr(sha1(CASE WHEN doc_id % 3 = 0 THEN 'texts/' || doc_id || '.txt' ELSE substr(bare, 1, 500) END), 1, 16) AS opinion_id, CAST(CASE WHEN doc_id % 3 = 0 THEN length(text) ELSE length(bare) END AS INTEGER) AS chars FROM b",
    "completion": f"WITH {LINES}, d AS (SELECT doc_id, string_agg(CASE WHEN norm IS NULL THEN line ELSE lower(norm) END, chr(10) ORDER BY pos) AS text, bool_and(norm IS NULL OR k >= '08') AS complete FROM lines GROUP BY doc_id) SELECT count(*) AS rows, count(*) FILTER (WHERE complete AND text <> '') AS with_text, count(DISTINCT CASE WHEN complete AND text <> '' THEN text END) AS distinct_texts, count(*) FILTER (WHERE complete) AS complete FROM d",
    "opinion_files": f"WITH {LINKED} SELECT link, path FROM f",
}
