import pytest
from pyspark.sql import functions as F

from pressglean.config import Settings, read_settings
from pressglean.functions import html as H
from pressglean.functions import keys as K
from pressglean.functions import text as T
from pressglean.functions import url as U


def values(spark, inputs, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_urls(spark):
    urls = ["https://a_b.com/x y|z.jpg", "mailto:x@y.z", "//h/p", "", None, "https://m.facebook.com:443/x", "http://www.youtube.com/watch", "https://h/a%3Fb.png", "HTTP://h/IMAGES/x", "ftp://h/x", "https://h/%zz/uploads/x", "https://h/a+b.PNG"]
    assert values(spark, urls, U.category) == ["images", None, None, None, None, "html", "social", "html", "images", "other", "images", "images"]
    assert values(spark, ["https://fb.com/x", "https://notfb.com", None], U.mentions) == [True, True, False]
    assert values(spark, ["ver (https://a.pe/x~y), y http://b.pe/z#t.", "nada", None], U.first_url) == ["https://a.pe/x", "", ""]
    assert values(spark, ["image/jpeg", "image/png; q=1", "image/svg+xml", "text", None], U.extension_of) == [".jpg", ".png", ".jpg", ".jpg", ".jpg"]


def test_text(spark):
    assert values(spark, ["  a  b\n", None], T.normalized) == ["a b", ""]
    assert values(spark, ["Ñandú  É", "é"], T.folded) == ["Nandu E", "e"]
    assert values(spark, ["a\x00b\tc", None], T.cleaned) == ["a b c", ""]
    assert values(spark, ["uno  dos", "a b c d e", "a b c d e f", "", None, "x http://q.pe/z y"], T.brief_description) == ["uno  dos", "a b c d e", "a b c d e...", "", "", "x  y"]
    assert values(spark, ["alertas", "-----", "ABCD", "A" * 51, "ÜBER ALLES", "Política / Economía", "texto", None], T.is_header) == [True, True, False, False, False, True, False, False]
    assert values(spark, ["POLITICA / ECONOMIA", "medio ambiente", "OTRA COSA"], T.canonical_header) == ["POLÍTICA / ECONOMÍA", "MEDIO AMBIENTE", "OTRA COSA"]
    assert values(spark, ["Managua y SUNASS", "agua, saneamiento, alcantarillado", "", None], T.relevance) == [pytest.approx(0.7), pytest.approx(0.6), 0.0, 0.0]
    assert values(spark, ["Read timeout", "HTTP Error: 404", None, ""], T.is_permanent_error) == [True, False, False, False]
    assert values(spark, ["Timeout", "HTTP Error: 1", "Network Error: x", "?", "", None], T.error_class) == ["timeout", "http", "network", "unexpected", None, None]
    assert values(spark, ["simple", "nope", None], T.prompt_key) == ["simple", "detallado", "detallado"]


def test_html(spark):
    page = '<html><head><title> A &amp; B </title><META content="d1" NAME="og:description"></head><nav><nav>x</nav>y</nav><p>Uno<b>dos</b></p><script>if (a<b) {"</p>"}</script><!-- c --></html>'
    assert values(spark, [page, "<p>sin</p>", None], H.title) == ["A & B", "", ""]
    assert values(spark, [page, None], H.meta_description) == ["d1", ""]
    assert values(spark, ["<p>Uno <b>dos</b></p><footer>f</footer>", None], H.visible_text) == ["Uno dos", ""]
    assert values(spark, [page, None], H.visible_text_nested) == ["A & B Uno dos", ""]
    assert values(spark, ["text/HTML; x", "image/png", None], H.is_html) == [True, False, False]


def test_keys(spark):
    assert values(spark, ["01042025", "31022025", "x", None], lambda c: K.parsed_date(c).cast("string")) == ["2025-04-01", None, None, None]
    assert values(spark, [[10.0, 5.0, 20.0, 9.0], [700.0, 5.0, 720.0, 9.0], None], lambda c: K.expanded(c, 595.0, 842.0), "array<double>") == [[0.0, 0.0, 50.0, 19.0], None, None]
    assert values(spark, [0.125, 0.135], lambda c: K.rounded(c), "double") == [0.12, 0.14]
    got = spark.range(1).select(K.fitted(F.lit(10000), F.lit(10000)).alias("f"), K.fitted(F.lit(10), F.lit(20)).alias("g")).first()
    assert (got.f.width, got.f.height, got.g.width, got.g.height) == (5000, 5000, 10, 20)


def test_settings(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("api:\n  batch_size: 3\nprompt_key: simple\n")
    s = read_settings(str(f), {"OCR_API_KEY": "k"})
    assert (s.api, s.prompt_key, Settings().api) == ({"batch_size": 3, "key": "k"}, "simple", {})
    assert read_settings(str(tmp_path / "none"), {}) == Settings()
    with pytest.raises(ValueError):
        Settings().merged({"nope": 1})
