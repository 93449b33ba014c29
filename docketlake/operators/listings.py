"""Case records, events and people out of the tables of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.html import CASE_LABELS, DEFENDANT_ROLES, EVENT_HEADERS, HEADERS, KNOWN_TABLE_IDS, NAME_HEADERS, PLAINTIFF_ROLES, ROLE_HEADERS, page_case_number
from docketlake.functions.tables import page_tables
from docketlake.functions.text import contains_any, labelled_entry
from docketlake.functions.urls import joined_url

CASE_FIELDS = ["case_number", "case_link", "date_of_receipt", "judge", "decision_date", "solution", "entry_into_force_date", "judicial_acts_link", "source_page"]
EVENT_FIELDS = ("event_name", "event_date", "event_time", "event_result", "event_basis", "event_published_date")
INFO_FIELDS = ("case_number", "judicial_uid", "date_filed", "hearing_type", "case_category", "judge", "current_stage")


def _with_key(pages: DataFrame) -> DataFrame:
    """Rows that repeat are pages of their own."""
    return pages.withColumn("_page", F.monotonically_increasing_id())


def _score(grid: Column) -> Column:
    """M-7: two for each of three fields that some header names, a tenth for each row up to 30."""
    heads = F.filter(F.flatten(grid), lambda c: c["head"] & c["own"])
    said = F.array_join(F.transform(heads, lambda c: c["text"]), " ")
    named = sum((F.when(contains_any(said, list(HEADERS[f])), 2).otherwise(0) for f in ("date_of_receipt", "judge", "case_number")), F.lit(0))
    return named + F.least(F.size(grid), F.lit(30)) * 0.1


def _blank_form() -> Column:
    """H-5: two rows at most, and no link to a case."""
    case = F.exists(F.flatten("grid"), lambda c: F.coalesce(F.contains(c["href"], F.lit("case_id=")), F.lit(False)))
    return (F.size("grid") <= 2) & ~case


def results_tables(pages: DataFrame) -> DataFrame:
    """H-3, H-5, SL-10: ``pages`` (with ``html``) that have a results table, with its ``grid``.

    That is the first table with a known id and more than one row, else the one that scores best, of equals the first;
    forms without results are left out.
    """
    columns = [c for c in pages.columns if c != "html"]
    tables = page_tables(_with_key(pages)).where("grid is not null")
    known = F.coalesce(F.col("id").isin(*KNOWN_TABLE_IDS), F.lit(False)) & (F.size("grid") > 1)
    rank = F.struct(known.alias("known"), F.when(known, F.lit(0.0)).otherwise(_score(F.col("grid"))).alias("score"), (-F.col("table")).alias("at"))
    best = tables.groupBy("_page").agg(*[F.first(c).alias(c) for c in columns], F.max_by("grid", rank).alias("grid"))
    return best.where(~_blank_form()).drop("_page")


def _first_naming(header: Column, words: tuple[str, ...]) -> Column:
    """The place of the first header with one of the words, -1 if there is none."""
    return F.array_position(F.transform(header, lambda h: contains_any(h, list(words))), F.lit(True)).cast("int") - 1


def case_records(pages: DataFrame) -> DataFrame:
    """H-4, H-6, PF-17, PF-18: the records of results pages (``url, page_num, html``); what a page lacks is empty.

    A field is the first column whose header has one of its words. A row counts if its case's cell, or else any of its cells,
    has a link with a text, which is the case's number.
    """
    found = results_tables(pages.select("url", F.col("page_num").cast("int").alias("page_num"), "html"))
    # Columns are found once for each table, below the rows.
    header = found.withColumn("header", F.transform(F.get("grid", F.lit(0)), lambda c: F.lower(c["text"])))
    places = header.select("url", "page_num", "grid", F.struct(*[_first_naming(F.col("header"), words).alias(f) for f, words in HEADERS.items()]).alias("at"))
    rows = places.select("url", "page_num", "at", F.explode(F.slice("grid", F.lit(2), F.size("grid"))).alias("row"))
    rows = rows.where(F.exists("row", lambda c: ~c["head"])).select("*", *[F.get("row", F.when(F.col(f"at.{f}") >= 0, F.col(f"at.{f}"))).alias(f"_{f}") for f in HEADERS])
    linked = F.get(F.filter("row", lambda c: c["href"].isNotNull() & c["own"]), F.lit(0))
    rows = rows.withColumn("_link", F.when(F.col("_case_number.href").isNotNull(), F.col("_case_number")).otherwise(linked)).where("_link.link <> ''")
    base = F.coalesce("url", F.lit(""))
    fields = {f: F.coalesce(f"_{f}.text", F.lit("")) for f in HEADERS}
    fields |= {
        "case_number": F.col("_link.link"),
        "case_link": joined_url(base, F.col("_link.href")),
        "judicial_acts_link": F.coalesce(joined_url(base, F.col("_judicial_acts_link.href")), F.lit("")),
        "source_page": F.col("page_num"),
    }
    return rows.select(*[fields[c].alias(c) for c in CASE_FIELDS])


def _event_field(header: Column) -> Column:
    """H-12: the field of a header, by the first rule that fits."""
    out = None
    for inside, equal, name in EVENT_HEADERS:
        fits = contains_any(header, list(inside)) | header.isin(*equal) if equal else contains_any(header, list(inside))
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def _people_field(header: Column) -> Column:
    """H-13."""
    named = contains_any(header, list(NAME_HEADERS)) | (F.contains(header, F.lit("наименование")) & ~F.contains(header, F.lit("событи")))
    return F.when(contains_any(header, list(ROLE_HEADERS)), "role").when(named, "name").when(F.contains(header, F.lit("инн")), "inn")


def _fields(field_of) -> Column:
    """The field of each column of a grid, by its header."""
    return F.transform(F.get("grid", F.lit(0)), lambda c: field_of(F.lower(c["text"])))


def _named_rows(fields: str, wanted: tuple[str, ...], needed: tuple[str, ...], keep) -> Column:
    """The rows of ``grid`` as structs of the wanted fields, those kept; null if the header lacks a needed one."""
    has = lambda f: F.coalesce(F.array_contains(fields, f), F.lit(False))
    at = lambda f: F.when(has(f), F.size(fields) - F.array_position(F.reverse(fields), F.lit(f)).cast("int"))
    row = lambda r: F.struct(*[F.coalesce(F.get(r, at(f))["text"], F.lit("")).alias(f) for f in wanted])
    complete = F.lit(True)
    for f in needed:
        complete = complete & has(f)
    return F.when(complete, F.filter(F.transform(F.slice("grid", F.lit(2), F.size("grid")), row), keep))


def _joined(people: Column, kind: str) -> Column:
    """AG-20 on one page: plaintiffs, defendants or all others, in order."""
    role, name = lambda p: p["role"], lambda p: F.when(p["name"] != "", p["name"]).otherwise(p["role"])
    plaintiff, defendant = lambda p: contains_any(role(p), list(PLAINTIFF_ROLES)), lambda p: contains_any(role(p), list(DEFENDANT_ROLES))
    if kind == "other":
        held = F.transform(F.filter(people, lambda p: ~plaintiff(p) & ~defendant(p)), lambda p: labelled_entry(role(p), name(p)))
        return F.array_join(F.filter(held, lambda x: x != ""), "; ")
    wanted = plaintiff if kind == "plaintiffs" else lambda p: defendant(p) & ~plaintiff(p)
    return F.array_join(F.transform(F.filter(people, wanted), name), "; ")


def case_event_rows(pages: DataFrame) -> DataFrame:
    """H-11..H-14, J-13, J-14, PF-20: case pages (``url, html``) to a row for each event, the case's fields repeated.

    Events come from the first table whose header names events and dates and that has a named event, people from the first
    with roles; labels in bold have their value in the cell beside them, the last one of a label counts. A page without
    events has one row.
    """
    numbered = _with_key(pages.select(F.col("url").alias("source_url"), "html")).withColumn("_number", page_case_number(F.col("html")))
    tables = page_tables(numbered).withColumns({"_events": _fields(_event_field), "_people": _fields(_people_field)})
    events = _named_rows("_events", EVENT_FIELDS, ("event_name", "event_date"), lambda r: r["event_name"] != "")
    people = _named_rows("_people", ("role", "name", "inn"), ("role",), lambda r: (r["role"] != "") | (r["name"] != "") | (r["inn"] != ""))
    pair = lambda r: F.struct(F.get(r, F.lit(0))["bold"].alias("label"), F.get(r, F.lit(1))["text"].alias("value"))
    pairs = F.filter(F.transform("grid", pair), lambda p: (p["label"] != "") & (p["value"] != ""))
    tables = tables.select("_page", "source_url", "_number", "table", events.alias("e"), people.alias("p"), pairs.alias("i"))
    first = lambda c: F.min_by(c, F.when(F.size(c) > 0, F.col("table")))
    info = F.array_sort(F.collect_list(F.when(F.col("table").isNotNull(), F.struct("table", "i"))))
    one = tables.groupBy("_page").agg(F.first("source_url").alias("source_url"), F.first("_number").alias("_number"), first("e").alias("e"), first("p").alias("p"), info.alias("i"))
    labels = F.flatten(F.transform("i", lambda t: t["i"]))

    def value(field: str) -> Column:
        said = [label for label, f in CASE_LABELS.items() if f == field]
        of = F.filter(labels, lambda x: F.lower(x["label"]).isin(*said) if said else F.lit(False))
        return F.coalesce(F.try_element_at(of, F.lit(-1))["value"], F.lit(""))

    fields = {f: F.coalesce("_number", F.lit("")) if f == "case_number" else value(f) for f in INFO_FIELDS}
    held = F.coalesce("p", F.array().cast("array<struct<role:string,name:string,inn:string>>"))
    rows = one.select("source_url", *[c.alias(f) for f, c in fields.items()], *[_joined(held, k).alias(f"participants_{k}") for k in ("plaintiffs", "defendants", "other")], F.explode_outer("e").alias("event"))
    return rows.select("source_url", *INFO_FIELDS, "participants_plaintiffs", "participants_defendants", "participants_other", *[F.coalesce(f"event.{f}", F.lit("")).alias(f) for f in EVENT_FIELDS])
