"""Operators on hand-written rows, and properties on drawn ones."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketlake.functions import html as H
from docketlake.functions import tables
from docketlake.operators import acquire, analytics, cases, corpus, listings, relational, translate

DAY = dt.date


def alone(norm, limit):
    """Which paragraphs are batches by themselves."""
    return len(norm) > limit or "@@@" in norm


@pytest.fixture(scope="module")
def records(spark):
    rows = [(1, "a", DAY(2025, 1, 5), "x", "P"), (2, "a", DAY(2025, 3, 5), None, "P"), (3, "a", None, "x", "Q"), (4, None, DAY(2025, 1, 1), "y", "Q"), (5, None, DAY(2025, 1, 1), "y", "Q"), (6, "b", None, " ", "P")]
    return spark.createDataFrame(rows, "id long, key string, day date, outcome string, court string")


def test_latest_per_key(records):
    kept = relational.latest_per_key(records, ["key"], F.col("day"), F.col("id"))
    assert sorted(r.id for r in kept.collect()) == [2, 5, 6]
    again = relational.latest_per_key(kept, ["key"], F.col("day"), F.col("id"))
    assert sorted(r.id for r in again.collect()) == [2, 5, 6]


def test_first_and_frequency(records):
    assert sorted(r.id for r in relational.first_per_key(records, ["key"], [F.col("id")]).collect()) == [1, 4, 6]
    assert {(r.value, r.first_seen) for r in relational.first_seen(records, F.col("court"), F.col("id")).collect()} == {("P", 1), ("Q", 3)}
    ranks = relational.value_frequency(records, "court", F.col("id")).collect()
    assert [(r.court, r.n, r["rank"]) for r in sorted(ranks, key=lambda r: r["rank"])] == [("P", 3, 1), ("Q", 3, 2)]


def test_pending(spark):
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    done = spark.createDataFrame([(1, None), (2, "no_text_found")], "k long, error string")
    assert sorted(r.k for r in relational.pending(wanted, done, "k").collect()) == [3]
    assert sorted(r.k for r in relational.pending(wanted, done, "k", retry_failures=True).collect()) == [2, 3]


def test_union_and_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    both = relational.tagged_union({"A": a, "B": b})
    assert sorted((r.x or 0, r.y or "", r.court_name) for r in both.collect()) == [(0, "t", "B"), (1, "", "A")]
    assert relational.ordered_columns(both, ["court_name", "none", "y"]).columns == ["court_name", "y", "x"]
    assert {(r.column, r.width) for r in relational.widths(spark.createDataFrame([("x" * 80, "ab")], "long string, s string")).collect()} == {("long", 55), ("s", 12)}


def test_monthly_counts(records):
    dated = analytics.with_month(records, "day")
    total = {r.month.month: r.n for r in analytics.monthly_counts(dated).collect()}
    assert total == {1: 3, 2: 0, 3: 1}
    by_key = analytics.monthly_counts(dated, ["key"]).collect()
    assert len(by_key) == 6
    assert sum(r.n for r in by_key) == 4
    levels = {r.level for r in analytics.monthly_levels(dated, "court", "outcome").collect()}
    assert levels == {"total", "court", "outcome", "court_outcome"}
    assert analytics.monthly_counts(dated.where("id < 0")).count() == 0


def test_population(spark):
    counts = spark.createDataFrame([("A", 30), ("Z", 5)], "court string, cases long")
    people = spark.createDataFrame([("A", "a", 25000, "L", 1.0, 2.0, 2), ("B", "b", 5000, "L", 3.0, 4.0, 1), ("C", "c", 0, "M", 5.0, 6.0, 3)], "court string, jurisdiction string, population long, locality string, lat double, lon double, ord long")
    assert {(r.court, r.jurisdiction, r.cases_per_10k) for r in analytics.per_capita(counts, people, "court").collect()} == {("A", "a", 12.0), ("Z", "UNKNOWN", None)}
    places = analytics.by_locality(people, counts, "court")
    assert {(r.locality, r.cases, r.population, r.lat) for r in places.collect()} == {("L", 30, 30000, 3.0), ("M", 0, 0, 5.0)}
    assert [(r.locality, r.per_10k) for r in analytics.with_locality_rate(places).collect()] == [("L", 10.0)]


def test_mean_days(spark):
    rows = spark.createDataFrame([(DAY(2025, 1, 1), DAY(2025, 1, 11)), (DAY(2025, 1, 5), DAY(2025, 1, 1)), (DAY(2025, 3, 1), None)], "a date, b date")
    assert sorted((r.month.month, r.avg_processing_days, r.n) for r in analytics.mean_days(rows, "a", "b").collect()) == [(1, 10.0, 1), (2, None, 0), (3, None, 0)]


def test_reassembly(spark):
    docs = spark.createDataFrame([(1, "Иск\n\n12\nИск  мой"), (2, "Суд"), (3, None), (4, "")], "doc_id long, text string")
    lines = corpus.lines_of(docs)
    none = spark.createDataFrame([], "k string, en string")
    back = {r.doc_id: (r.text, r.complete) for r in corpus.reassembled(lines, none, gate=False).collect()}
    assert back == {1: ("Иск\n\n12\nИск  мой", False), 2: ("Суд", False), 4: ("", True)}
    cache = corpus.unique_paragraphs(lines).where("norm <> 'Суд'").select("k", F.concat(F.lit("en:"), F.col("norm")).alias("en"))
    done = {r.doc_id: (r.text, r.complete) for r in corpus.reassembled(lines, cache).collect()}
    assert done == {1: ("en:Иск\n\n12\nen:Иск мой", True), 2: (None, False), 4: ("", True)}
    stats = corpus.paragraph_stats(lines).first()
    assert (stats.documents, stats.occurrences, stats.unique_paragraphs) == (3, 3, 3)


def sequential(norms, limit):
    """Greedy packing in one pass."""
    packer, out = corpus._Packer(limit), []
    for n in norms:
        out.append(packer.put(len(n), alone(n, limit)))
    return out


@given(st.lists(st.integers(0, 14).map(lambda n: "x" * n if n != 13 else "a@@@b"), max_size=30), st.integers(0, 29))
@settings(max_examples=300, deadline=None)
def test_effects_compose(norms, cut):
    import numpy as np

    limit, parts = 10, (norms[:cut], norms[cut:])
    size, batch = -1, -1
    for part in parts:
        sizes, counts = corpus._effect(np.array([len(x) for x in part], dtype=np.int64), np.array([alone(x, limit) for x in part], dtype=bool), limit)
        size, batch = int(sizes[size]), batch + int(counts[size])
    packer = corpus._Packer(limit)
    for n in norms:
        packer.put(len(n), alone(n, limit))
    assert (size, batch) == (packer.size, packer.batch)


def test_pack_batches(spark):
    import random

    random.seed(3)
    norms = ["w" * random.choice((3, 40, 200, 700, 1193, 1200, 1300)) + ("@@@" if i % 17 == 0 else "") for i in range(400)]
    df = spark.createDataFrame(list(enumerate(norms)), "pos long, norm string")
    packed = sorted(corpus.pack_batches(df, ["pos"]).collect(), key=lambda r: r.pos)
    assert [r.batch_id for r in packed] == sequential(norms, corpus.MAX_CHARS)
    batches: dict = {}
    for r in packed:
        batches.setdefault(r.batch_id, []).append(r.norm)
    assert all(len(b) == 1 or len(corpus.DELIMITER.join(b)) <= corpus.MAX_CHARS for b in batches.values())
    assert corpus.pack_batches(df.limit(0), ["pos"]).count() == 0


@given(st.text(alphabet="ab. \n", max_size=120), st.integers(4, 20))
@settings(max_examples=300, deadline=None)
def test_pieces_keep_order(text, limit):
    flat = lambda x: "".join(x.split())
    for cut in (corpus.sentence_pieces, corpus.paragraph_chunks):
        pieces = cut(text, limit)
        assert all(p and len(p) <= limit for p in pieces if p.strip()) or cut is corpus.paragraph_chunks
        assert flat("".join(pieces)) == flat(text)


def test_translation(spark):
    calls = []

    def mangling(text):
        calls.append(text)
        return None if text == "bad" else text.replace("@@@@@", "").upper()

    assert translate.translate_batch(mangling, ["a", "bad", "c"]) == ["A", None, "C"]
    assert len(calls) == 6
    assert translate.translate_batch(str.upper, ["a", "b"]) == ["A", "B"]
    assert translate.translate_paragraph(str.upper, "Ab. " * 400) == " ".join(p.upper() for p in corpus.sentence_pieces("Ab. " * 400))
    with pytest.raises(RuntimeError):
        translate.check_translator(lambda _: "")


def test_long_values_and_paragraphs_are_translated_whole(spark):
    texts = ["Короткий.", "Одно предложение. " * 400, "ж" * 9001, "x"]
    values = {r.value: r.en for r in translate.translate_values(spark.createDataFrame([(t,) for t in texts], "value string"), str.upper).collect()}
    assert values[texts[0]] == "КОРОТКИЙ." and values["x"] == "x"
    assert all(values[t].replace(" ", "") == t.upper().replace(" ", "") for t in texts[:3])
    rows = spark.createDataFrame([(f"k{i}", t.strip(), i) for i, t in enumerate(texts[:3])], "k string, norm string, pos long")
    got = {r.k: r.en for r in translate.translate_pending(rows, spark.createDataFrame([], "k string, en string"), str.upper, ["pos"]).collect()}
    assert got["k0"] == "КОРОТКИЙ." and all(got[f"k{i}"].replace(" ", "") == t.upper().replace(" ", "") for i, t in enumerate(texts[:3]))


def test_second_run_translates_nothing(spark):
    rows = spark.createDataFrame([("k1", "раз", 1), ("k2", "два", 2), ("k3", "три", 3)], "k string, norm string, pos long")
    empty = spark.createDataFrame([], "k string, ru string, en string")
    first = translate.translate_pending(rows, empty, str.upper, ["pos"])
    assert sorted((r.k, r.en) for r in first.collect()) == [("k1", "РАЗ"), ("k2", "ДВА"), ("k3", "ТРИ")]
    assert translate.translate_pending(rows, first, str.upper, ["pos"]).count() == 0
    assert translate.without_untranslated(first).count() == 0


def test_what_is_missing_is_found_once(spark):
    """The paragraphs that a translation is asked for are computed once, and lines are normalised once on the way to them."""
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = spark.createDataFrame([(f"k{i}", f"text {i}", i) for i in range(20)], "k string, norm string, pos long").mapInPandas(counted, "k string, norm string, pos long")
    assert translate.translate_pending(rows, spark.createDataFrame([], "k string, en string"), str.upper, ["pos"]).count() == 20
    assert seen.value == 20
    docs = spark.createDataFrame([(1, "a \u00a0 b\n\n \n12\n\tc\x1f"), (2, None), (3, "")], "doc_id long, text string")
    lines = corpus.lines_of(docs, pattern="[A-Za-z]")
    assert [(r.doc_id, r.pos, r.line, r.norm) for r in lines.orderBy("doc_id", "pos").collect()] == [(1, 0, "a \u00a0 b", "a b"), (1, 1, "", None), (1, 2, " ", None), (1, 3, "12", None), (1, 4, "\tc\x1f", "c"), (3, 0, "", None)]
    plan = corpus.unique_paragraphs(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


RESULTS_PAGE = """<html><head><title>Тестовский районный суд</title></head><body><p>Всего по запросу найдено — 57. На странице записи с 1 по 25.</p>
<table id="tablcont"><tr><th>№ дела</th><th>Дата поступления</th><th>Судья</th><th>Дата решения</th><th>Решение</th><th>Дата вступления в законную силу</th><th>Судебные акты</th></tr>
<tr><td><a href="/modules.php?name_op=case&amp;case_id=7">2-7/2025</a><td>01.02.2025<td>Тестов Т. Т.<td>03.03.2025<td>Иск УДОВЛЕТВОРЕН<td>04.04.2025<td><a href="doc?n=7">акт</a>
<tr><td>без ссылки</td></tr>
<tr><td><a href="case?case_id=97">2-97/2025</a></td><td>02.02.2025</td><td></td><td></td><td></td><td></td><td></td></tr></table></body></html>"""
CASE_PAGE = """<html><body><h2>Дело № 2-4/2025</h2><table><tr><td><b>Судья</b></td><td>Тестов  Т. Т.</td></tr><tr><td><b>Категория дела</b></td><td>Споры 4</td></tr></table>
<table><tr><th>Наименование события</th><th>Дата</th><th>Время</th></tr><tr><td>Регистрация</td><td>01.02.2025</td><td>10:00</td></tr><tr><td>Заседание</td><td>02.02.2025</td><td></td></tr></table>
<table><tr><th>Вид лица, участвующего в деле</th><th>Фамилия / наименование</th></tr><tr><td>ИСТЕЦ</td><td>А4</td></tr><tr><td>Ответчик</td><td>Б4</td></tr><tr><td>Прокурор</td><td>В4</td></tr></table></body></html>"""


def records_of(spark, *pages, url="https://court.example/a/b?x=1"):
    df = spark.createDataFrame([(url, 3, p, "clash") for p in pages], "url string, page_num int, html string, grid string")
    return listings.case_records(df).orderBy("case_number").collect()


def test_results_page(spark):
    rows = records_of(spark, RESULTS_PAGE)
    assert [r["case_number"] for r in rows] == ["2-7/2025", "2-97/2025"]
    assert rows[0]["case_link"] == "https://court.example/modules.php?name_op=case&case_id=7"
    assert rows[0]["judicial_acts_link"] == "https://court.example/a/doc?n=7" and rows[1]["judicial_acts_link"] == ""
    assert rows[0]["solution"] == "Иск УДОВЛЕТВОРЕН"
    assert (rows[1]["judge"], rows[1]["source_page"]) == ("", 3)
    assert len(records_of(spark, RESULTS_PAGE, RESULTS_PAGE, None)) == 4


def test_pages_without_results(spark):
    assert records_of(spark, "", None, "<p>no table", "<table><tr><th>Дело</th></tr><tr><td><a href='?x=1'>1</a></td></tr></table>", "<table></table>", "<table id=tablcont><tr></table>") == []


def test_results_by_score(spark):
    page = "<table><tr><td>menu</td><table><tr><th>Судья<th>Номер дела</tr><tr><td>А<td><a href=c?case_id=1>2-1</a></tr></table>"
    assert [(r["judge"], r["case_number"]) for r in records_of(spark, page)] == [("А", "2-1")]
    equal = "".join(f"<table><tr><th>Судья<th>Дело<tr><td>{x}<td><a href=c?case_id=1>2-1</a></table>" for x in "АБ")
    assert [r["judge"] for r in records_of(spark, equal)] == ["А"]
    assert H.result_count("<b>Найдено дел: 123</b>") == 123
    assert H.result_count("<p>ничего</p>") is None


def grid(html):
    return [[c["text"] for c in row] for row in tables.grid_of(H.parse(html).first("table"))]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", [["a", "b"], ["a", "c"]]),
        ("<table><tr><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>", [["a", "a", "b"], ["c", "d", "e"]]),
        ("<table><tr><td rowspan=3 colspan=2>a<td>b<tr><td>c<tr><td>d<tr><td>e</table>", [["a", "a", "b"], ["a", "a", "c"], ["a", "a", "d"], ["e"]]),
        ("<table><thead><tr><th rowspan=0>h<th>i</thead><tbody><tr><td rowspan=9>a<td>b<tr><td>c</tbody><tfoot><tr><td>f</tfoot></table>", [["h", "i"], ["a", "b"], ["a", "c"], ["f"]]),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c</tbody></table>", [["a", "b"], ["a", "c"]]),
        ("<table><tr><td>a<td rowspan=2>b<tr><td colspan=3>c</table>", [["a", "b"], ["c", "b", "c"]]),
        ("<table><tr><td>a<td><td rowspan=2>z<tr><td>b</table>", [["a", "", "z"], ["b", "", "z"]]),
        ("<table><tr><td>out<table><tr><td>in</table>side<td>x</table>", [["out side", "x"]]),
        ("<table><tr><td colspan=0>a<td rowspan=x>b<td colspan=-1>c</table>", [["a", "b", "c"]]),
        ("<table><caption>c</caption></table>", []),
        ("<table><tr></tr><tr><td> a&nbsp;b\n<b>c</b> </table>", [[], ["a b c"]]),
    ],
)
def test_grids(html, want):
    assert grid(html) == want


def test_spans_are_bounded():
    wide = tables.grid_of(H.parse("<table><tr><td colspan=999999 rowspan=99999999>a<tr><td>b</table>").first("table"))
    assert [len(r) for r in wide] == [1000, 1001]


def test_records_under_spans(spark):
    """A judge's cell that several cases share counts for each; its link names none of them."""
    page = "<table id=tablcont><tr><th>Судья<th>№ дела<th>Решение<tr><td rowspan=3><a href=j>Т</a><td><a href='?case_id=1'>1</a><td>x<tr><td><a href='?case_id=2'>2</a><td rowspan=2>y<tr><td>none</table>"
    got = [(r["judge"], r["case_number"], r["solution"]) for r in records_of(spark, page)]
    assert got == [("Т", "1", "x"), ("Т", "2", "y")]


def test_case_page(spark):
    pages = spark.createDataFrame([("u", CASE_PAGE, 1), ("none", "", 2), ("null", None, 3)], "url string, html string, _page int")
    rows = listings.case_event_rows(pages).orderBy("source_url", "event_name").collect()
    assert [(r.source_url, r.event_name, r.event_date, r.event_time) for r in rows] == [("none", "", "", ""), ("null", "", "", ""), ("u", "Заседание", "02.02.2025", ""), ("u", "Регистрация", "01.02.2025", "10:00")]
    assert (rows[2].case_number, rows[2].judge, rows[2].case_category) == ("Дело № 2-4/2025", "Тестов Т. Т.", "Споры 4")
    assert (rows[2].participants_plaintiffs, rows[2].participants_defendants, rows[2].participants_other) == ("А4", "Б4", "Прокурор: В4")
    assert rows[0].case_number == "" and rows[0].participants_other == ""
    assert H.case_number_of("<h3>По делу 2-5/2024 </h3>") == "По делу 2-5/2024"


def test_main_text():
    long = "Слово " * 30
    assert H.main_text(f"<div id=content><h1>x</h1><span><p>{long}<p>{long}</span></div>") == f"{long.strip()}\n{long.strip()}"
    assert H.main_text(f"<div id=content><span>short</span><p>{long}</div>").startswith("short\n")
    assert H.main_text("<div>" + f"<p>{long}</p>" * 5 + "<script>x</script></div>").count("\n") == 4
    assert H.main_text("<div><p>a</div>") is None


def test_charset():
    assert H.decode_body("суд".encode("cp1251")) == "суд"
    assert H.decode_body("суд".encode(), "text/html; charset=UTF-8") == "суд"
    assert H.decode_body(b"<meta charset='utf-8'>" + "суд".encode()) == "<meta charset='utf-8'>суд"
    assert H.decode_body("суд".encode("cp1251"), "text/html; charset=none-such") == "суд"


def test_outcomes(spark):
    pages = spark.createDataFrame([(RESULTS_PAGE,), (None,)], "html string")
    outcomes = pages.select(F.coalesce(H.fetch_outcome(F.col("html"), F.lit(None)), F.lit("ok")).alias("o")).collect()
    assert [r.o for r in outcomes] == ["no_text_found", "fetch_failed"]


def test_participants(spark):
    rows = spark.createDataFrame([(1, 1, "Истец", "А"), (1, 2, "Ответчик", ""), (1, 3, "Эксперт", "В"), (1, 4, None, None), (2, 1, "истец", "Г")], "c long, t long, role string, name string")
    found = {r.c: r for r in cases.participants_pivot(rows, "c", "role", "name", "t").collect()}
    assert (found[1].participants_plaintiffs, found[1].participants_defendants, found[1].participants_other) == ("А", "Ответчик", "Эксперт: В")
    assert found[2].participants_defendants == ""


def test_texts_of_cases(spark):
    rows = spark.createDataFrame([(1, "2-1/25", " u "), (2, "2-2/25", "u"), (3, "2-3/25", None), (4, "2-4/25", "v")], "id long, n string, link string")
    texts = spark.createDataFrame([("u", "text"), ("w", None)], "url string, opinion_text string")
    found = {r.id: (r.opinion_text, r.opinion_text_file) for r in cases.with_texts(rows, texts, "link", "n", "id").collect()}
    assert found[1] == found[2] and found[1][0] == "text" and found[1][1].startswith("opinion_fulltexts/2-1_25_")
    assert found[3] == found[4] == ("", "")


class Site:
    def __init__(self, pages, robots=(404, b"", "")):
        self.pages, self.robots, self.seen = pages, robots, []

    def __call__(self, url):
        self.seen.append(url)
        if url.endswith("/robots.txt"):
            return self.robots
        answer = self.pages.get(url, (200, b"", ""))
        return answer.pop(0) if isinstance(answer, list) else answer


def quiet():
    return acquire.Pace(sleep=lambda _: None)


def test_crawl():
    one = "найдено - 60".encode()
    site = Site({"https://c.example/l?page=1": (200, one, "charset=utf-8"), "https://c.example/l?page=2": (500, b"", ""), "https://c.example/l?page=3": [(429, b"", ""), (200, b"3", "")]})
    got = list(acquire.crawl(acquire.Fetcher(site, quiet()), "https://c.example/l"))
    assert [p for _, p, _ in got] == [1, 3]
    assert [p for _, p, _ in acquire.crawl(acquire.Fetcher(Site({"https://c.example/l?page=1": (200, one, "charset=utf-8")}), quiet()), "https://c.example/l", 2)] == [1, 2]


def test_robots_are_honoured():
    site = Site({}, (200, b"User-agent: *\nDisallow: /", ""))
    assert acquire.Fetcher(site, quiet()).fetch("https://c.example/l") is None
    assert site.seen == ["https://c.example/robots.txt"]


def test_failing_list_is_left_out():
    def broken(url):
        if "bad" in url:
            raise ValueError(url)
        return 200, b"", ""

    got = list(acquire.crawl_all(acquire.Fetcher(broken, quiet()), ["https://bad.example/", "https://c.example/"], 1))
    assert [b for b, *_ in got] == ["https://c.example/"]


def test_page_url():
    given = ["https://c.example/l", "https://c.example/l?", "https://c.example/l?a=1&page=12x&page=3", "https://c.example/l?page=", "https://c.example/l?homepage=2", "l?a=1#x"]
    assert [acquire.page_url(u, 7) for u in given] == [
        "https://c.example/l?page=7", "https://c.example/l?&page=7", "https://c.example/l?a=1&page=7x&page=3", "https://c.example/l?page=7", "https://c.example/l?homepage=2&page=7", "l?a=1#x&page=7",
    ]


def test_segments():
    assert corpus.segments_of(" a b @@@ c\n@@@@@@\n\n@@@") == ["a b", "c"] and corpus.segments_of(None) == []


MARKUP = ["<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "<td colspan=2>", '<TD rowspan="2">', '<a href="x?a=1&amp;b=2">', '<a href="x?a&lt=1">', "</a>", "text ", "&amp;", "&lt", "<", ">", "<br/>", "<!-- c -->", "<!-->", "<!DOCTYPE html>", '<script>x="</p>"</script>', "<script>", "</script>", "<title>", "</title>", "<div class=a/b>", "<td a = 1>", "<textarea>", "</ p>", "</", "&#65;", "<![CDATA[x]]>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(MARKUP), max_size=9).map("".join))
def test_plain_markup_is_parsed_as_by_the_standard_parser(html):
    standard, plain = H._Builder(), H._Builder()
    standard.feed(html)
    standard.close()
    assert H.parse(html) == standard.root
    assert not H._parsed_plainly(html, plain) or plain.root == standard.root


def test_pages_are_plain_markup():
    """A page with a script, references and spans does not need the standard parser."""
    html = '<!DOCTYPE html><html><head><title>a &amp; b</title><script>var t="</p>";</script></head><body><table id="menu"><tr><td rowspan="2"><a href="x?a=1&amp;b=2">y</a><td colspan=2>z</table></body></html>'
    assert H._parsed_plainly(html, H._Builder())
