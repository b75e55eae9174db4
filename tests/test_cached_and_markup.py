from pyspark.sql import functions as F

from pressglean.functions import html as H
from pressglean.operators import cache as C
from pressglean.operators import stats as A
from pressglean.plans import boundary as B


def test_pages_as_they_are(spark):
    markup = "<title>a &amp; b</title><nav>x<nav>y</nav>z</nav><p>uno &#243; &hellip;</p><footer>f</footer>dos"
    bodies = [("<p>ní</p>".encode("latin-1"), "text/html; charset=latin-1"), ("<meta charset='cp1252'>“ñ”".encode("cp1252"), None), ("ñ".encode(), "text/html"), (b"\xff", "text/html; charset=nothing"), (None, None)]
    df = spark.createDataFrame(bodies, "body binary, kind string")
    assert [r[0] for r in df.select(H.decoded_body(F.col("body"), F.col("kind"))).collect()] == ["<p>ní</p>", "<meta charset='cp1252'>“ñ”", "ñ", "�", None]
    page = spark.createDataFrame([(markup,), ("<p>plano</p>",), (None,)], "page string")
    assert [r[0] for r in page.select(H.page_text(F.col("page"))).collect()] == ["a & b uno ó … dos", "plano", ""]
    assert [r[0] for r in page.select(H.title(F.col("page"))).collect()] == ["a & b", "", ""]


def test_answers_from_the_cache(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    cache = spark.createDataFrame([("ocr", "k1", '{"text": "viejo"}', None), ("ocr", "k2", '{"text": "pasado"}', 60)], "ns string, key string, content string, expiry_seconds long").withColumn("ts", F.lit("2024-01-01 12:00:00").cast("timestamp")).select("ns", "key", "ts", "content", "expiry_seconds")
    asks = spark.createDataFrame([("ocr", "k1", 1), ("ocr", "k2", 2), ("ocr", "k3", 3), ("ocr", "k3", 4), ("ocr", None, 5)], "ns string, key string, n int")
    asked = []

    def ask(misses):
        asked.extend(sorted(str(r.key) for r in misses.collect()))
        return misses.select("ns", "key", F.lit("nuevo").alias("text"), F.when(F.col("key") == "k3", "memory").alias("error"))

    out, after = C.cached_or_asked(asks, cache, ask, "text string, error string", now)
    assert sorted((r.n, r.hit, r.text, r.error) for r in out.collect()) == [(1, True, "viejo", None), (2, False, "nuevo", None), (3, False, "nuevo", "memory"), (4, False, "nuevo", "memory"), (5, False, None, None)]
    assert asked == ["None", "k2", "k3"]
    kept = {r.key: r.expiry_seconds for r in after.collect()}
    assert kept["k1"] is None and kept["k2"] is None and kept["k3"] == 315_360_000
    again, _ = C.cached_or_asked(asks.where("key is not null"), after, ask, "text string, error string", now)
    assert all(r.hit for r in again.collect())
    row = C.with_defaults(spark.createDataFrame([(None, "e")], "extracted_text string, error string"), F.lit("f.png"), F.lit("2024-05-06").cast("date")).first()
    assert (row.image_filename, row.processed_date, row.extracted_text, row.error) == ("f.png", "06052024", "", "e")


def test_pdf_boundary(spark):
    files = spark.createDataFrame([("a.pdf", b"x"), ("b.txt", b"x"), ("c.PDF", None), ("d.pdf", b"bad")], "path string, content binary")

    def read(path, content):
        if content == b"bad":
            raise ValueError(content)
        return [(1, 1, "https://a.pe", [1.0, 2.0, 3.0, 4.0]), (2, 2, "https://b.pe", None)]

    assert [(r.path, r.page, r.url) for r in B.read_from(files, read, B.PDF_LINKS).orderBy("page").collect()] == [("a.pdf", 1, "https://a.pe"), ("a.pdf", 2, "https://b.pe")]


def test_any_success(spark):
    days = spark.createDataFrame([(False,), (True,)], "success boolean")
    assert tuple(A.any_success(days).first()) == (True, 2, 1) and tuple(A.any_success(days.limit(0)).first()) == (False, 0, 0)
