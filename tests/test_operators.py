import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from pressglean.operators import cache as C
from pressglean.operators import links as L
from pressglean.operators import sections as S
from pressglean.operators import stats as A


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_history(spark):
    links = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "i int, url string")
    hist = spark.createDataFrame([("a",), (None,), ("a",)], "url string")
    assert rows(L.unseen(links, hist), "i") == [(2,), (3,), (4,)]
    assert rows(L.seen(links, hist), "i") == [(1,)]
    assert rows(L.extended_history(hist, links)) == [("a",), ("b",)]
    assert rows(L.added_count(hist, links)) == [(2, 1)]
    assert rows(L.added_count(hist.limit(0), links.limit(0))) == [(0, 0)]
    assert L.unseen(links, hist).count() + L.seen(links, hist).count() == links.count()


def test_first_and_backlog(spark):
    df = spark.createDataFrame([(2, 1, "a", "x"), (1, 9, "a", None), (1, 9, None, "y")], "page int, no int, url string, c string")
    assert rows(L.first_of_each(df, "url", "page", "no")) == [(1, 9, "a", None), (1, 9, None, "y")]
    older = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, None)], "i int, url string")
    cur, hist = older.where("i = 1"), older.where("i = 4").select("url")
    assert rows(L.older_backlog(older, cur, hist, "i"), "i") == [(2,)]


def test_numbering_matches_window(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "a", "a", "b", None]), rng.random()) for i in range(500)]
    df = spark.createDataFrame(data, "i int, g string, x double")
    got = {r.i: r.rn for r in L.numbered(df, ["g"], ["x", "i"]).collect()}
    want = {}
    for g in {d[1] for d in data}:
        for n, d in enumerate(sorted((d for d in data if d[1] == g), key=lambda d: (d[2], d[0])), 1):
            want[d[0]] = n
    assert got == want
    assert L.numbered(df.limit(0), ["g"], ["x"]).count() == 0


def test_batches(spark):
    df = spark.createDataFrame([(i, "d", 2.0 if i % 3 == 0 else 1.0) for i in range(10)], "i int, ds string, mb double")
    got = {r.i: (r.large, r.batch) for r in L.batches(df, ["ds"], ["i"], F.col("mb")).collect()}
    assert [got[i][1] for i in (1, 2, 4, 5, 7, 8)] == [1, 1, 1, 2, 2, 2]
    assert [got[i] for i in (0, 3, 6, 9)] == [(True, 3), (True, 3), (True, 4), (True, 4)]
    assert {r.i: r.batch for r in L.even_batches(df, [], ["i"], 4).collect()} == {i: i // 4 + 1 for i in range(10)}


def test_cache(spark):
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    content = json.dumps({"image_filename": "x.jpg", "permanent_error": True, "error": "Timeout"})
    cache = spark.createDataFrame([("ocr", "k", at(0), "old", None), ("ocr", "k", at(5), "new", 10), ("ocr", "z", at(0), None, None), ("ocr", "p", at(0), content, None)], "ns string, key string, ts timestamp, content string, expiry_seconds long")
    ask = spark.createDataFrame([(1, "ocr", "k"), (2, "ocr", "k"), (3, "ocr", "z"), (4, "page", "k")], "i int, ns string, key string")
    hit = lambda s: rows(C.looked_up(ask, cache, F.lit(at(s))), "i", "hit", "content")
    assert hit(14) == [(1, True, "new"), (2, True, "new"), (3, False, None), (4, False, None)]
    assert [h for _, h, _ in hit(15)] == [False] * 4
    assert [r.image_filename for r in C.skipped_forever(cache).collect()] == ["x.jpg"]
    assert C.without_skipped(cache, "x.jpg").count() == 3
    assert C.saved(cache, cache).count() == 3
    e = spark.createDataFrame([("out of memory",), ("x",), ("",), (None,)], "e string")
    assert [r[0] for r in e.select(C.expiry_of(F.col("e"))).collect()] == [315360000, 3600, 86400, 86400]


def test_sections(spark):
    data = [("d", 1, 0, "intro"), ("d", 1, 1, "ALERTAS"), ("d", 1, 2, "uno"), ("d", 2, 0, " \n"), ("d", 2, 1, "dos a@b.pe"), ("d", 2, 2, "tres http://x.pe/y"), ("d", 3, 0, "Sector"), ("d", 3, 1, "cuatro"), ("d", 4, 0, "alertas"), ("d", 4, 1, "cinco"), ("e", 1, 0, None)]
    blocks = spark.createDataFrame(data, "doc_id string, page int, block_no int, text string")
    s = S.sectioned(blocks)
    assert rows(s, "text", "section") == [("cinco", "ALERTAS"), ("cuatro", "SECTOR"), ("dos a@b.pe", "ALERTAS"), ("intro", "CONTENIDO_INICIAL"), ("tres http://x.pe/y", "ALERTAS"), ("uno", "ALERTAS")]
    p = S.paragraphs(s)
    assert rows(p.where("url <> ''"), "description", "url") == [("tres", "http://x.pe/y")]
    g = {r.section: [x.text for x in r.paragraphs] for r in S.grouped(p).collect()}
    assert g["ALERTAS"] == ["uno", "tres http://x.pe/y", "cinco"]
    assert rows(S.section_counts(p)) == [(3, 5)]
    assert rows(S.joined_pages(spark.createDataFrame([("d", 2, "b"), ("d", 1, " a")], "doc_id string, page int, text string"))) == [("d", "a\n\nb")]


def test_words_in_boxes(spark):
    rng = random.Random(3)
    words = [("p", x, y, x + 8, y + 6, f"w{i}", i) for i in range(80) for x, y in [(rng.uniform(0, 500), rng.uniform(0, 800))]]
    boxes = [("p", k, [x, y, x + 150, y + rng.uniform(5, 200)]) for k in range(15) for x, y in [(rng.uniform(0, 400), rng.uniform(0, 700))]] + [("p", 99, None)]
    got = {r.k: r.text for r in S.words_in_boxes(spark.createDataFrame(words, "page string, x0 double, y0 double, x1 double, y1 double, word string, word_no int"), spark.createDataFrame(boxes, "page string, k int, box array<double>"), ["page"], "k").collect()}
    want = {}
    for _, k, b in boxes:
        hit = [w[5] for w in words if b and b[0] <= w[1] + 4 <= b[2] and b[1] <= w[2] + 3 <= b[3]]
        if hit:
            want[k] = " ".join(hit)
    assert got == want


def test_stats(spark):
    pages = spark.createDataFrame([("a", 0.5, None), ("a", 0.2, ""), ("b", 0.9, "Timeout"), ("c", None, None)], "url string, relevance double, error string")
    r = A.page_stats(pages).first()
    assert (r.attempted, r.processed, r.successful, r.relevant, round(r.average_relevance, 4)) == (4, 3, 3, 1, 0.2333)
    assert A.page_stats(pages.limit(0)).first().average_relevance == 0.0
    caps = spark.createDataFrame([("u", True, "f", "t"), ("v", False, None, None), ("w", True, "g", "")], "url string, success boolean, pdf_path string, extracted_text string")
    assert rows(A.capture_stats(caps, caps)) == [(3, 2, 1)]
    assert rows(A.capture_texts(caps, caps), "url") == [("u",)]
    days = A.calendar(spark, "2024-01-30", "2024-02-02")
    got = A.day_status(days, spark.createDataFrame([("2024-01-31", "x"), ("2024-01-31", None)], "ds string, text string").withColumn("ds", F.col("ds").cast("date")))
    assert [(str(r.ds), r.success, r.n, r.texts) for r in got.orderBy("ds").collect()] == [("2024-01-30", False, 0, 0), ("2024-01-31", True, 2, 1), ("2024-02-01", False, 0, 0), ("2024-02-02", False, 0, 0)]
    assert A.calendar(spark, "2024-02-02", "2024-02-01").count() == 0
