import json

from pyspark.sql import functions as F

import __spark_entry__ as entry
from pressglean.plans import pipeline as P
from pressglean.plans.boundary import outcome, page_double, retried
from pressglean.sources import readers as R
from pressglean.sources import writers as W
from pressglean.streaming import ingest as I


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "In"
    d.mkdir()
    (d / "links_extracted_01042025.csv").write_text('Page,URL,Rect,Context\n1,https://a.pe/x,"(1.0, 2.0, 3.0, 4.5)","dice ""sí"", y más"\n2,https://b.pe/img/z,,fin\n')
    got = [tuple(r) for r in R.link_csv(spark, f"{d}/*.csv").orderBy("link_no").collect()]
    assert [(str(g[0]), *g[1:]) for g in got] == [("2025-04-01", 1, 1, "https://a.pe/x", [1.0, 2.0, 3.0, 4.5], 'dice "sí", y más'), ("2025-04-01", 2, 2, "https://b.pe/img/z", None, "fin")]
    assert R.link_csv(spark, f"{d}/none*.csv").count() == 0
    (d / "image_links_02042025.json").write_text("﻿" + json.dumps({"https://b.pe/z": {"filepath": "/f", "size": 5}, "https://b.pe/w": {"error": "Timeout"}}), encoding="utf-8")
    meta = R.image_metadata(spark, f"{d}/image_links_*.json")
    assert sorted((str(r.ds), r.url, r.size, r.error) for r in meta.collect()) == [("2025-04-02", "https://b.pe/w", None, "Timeout"), ("2025-04-02", "https://b.pe/z", 5, None)]
    assert [r.url for r in R.valid_items(meta).collect()] == ["https://b.pe/z"]
    (d / "social_links_03042025_unprocessed.json").write_text(json.dumps([{"Page": 1, "URL": "u", "Rect": [1, 2, 3, 4], "Context": "c"}]))
    assert R.link_snapshots(spark, f"{d}/social*").first().rect == [1.0, 2.0, 3.0, 4.0]
    assert R.link_snapshots(spark, f"{d}/social*", skip_day="03042025").count() == 0
    (d / "h.json").write_text('["b", "a", "a"]')
    (d / "broken.json").write_text('["b", ')
    assert sorted(r.url for r in R.history(spark, f"{d}/h.json").collect()) == ["a", "b"]
    assert R.history(spark, f"{d}/broken.json").count() == 0
    (d / "ocr_k1.json").write_text(json.dumps({"timestamp": 1700000000.5, "content": {"error": None, "x": 1}, "expiry_seconds": 9}))
    c = R.cache_files(spark, f"{d}/*.json").first()
    assert (c.ns, c.key, c.expiry_seconds, json.loads(c.content)["x"]) == ("ocr", "k1", 9, 1)
    assert [r.filename for r in R.local_images(spark, str(d)).collect()] == []
    df = spark.createDataFrame([("u", [1.5, 2.0])], "url string, rect array<double>")
    assert W.as_csv(df, f"{tmp_path}/o.csv") and not W.as_csv(df.limit(0), f"{tmp_path}/p.csv")
    assert spark.read.csv(f"{tmp_path}/o.csv", header=True).first().rect == "(1.5, 2.0)"
    W.as_map(df, "url", f"{tmp_path}/m.json")
    assert json.loads(spark.read.text(f"{tmp_path}/m.json").first()[0]) == {"u": {"rect": [1.5, 2.0]}}
    where = W.history_version(spark.createDataFrame([("b",), ("a",)], "url string"), f"{tmp_path}/hist", 1)
    assert sorted(r.url for r in spark.read.parquet(where).collect()) == ["a", "b"]
    snap = df.select(F.lit("2024-01-01").alias("ds"), F.lit("html").alias("category"), "url")
    W.snapshots(snap, f"{tmp_path}/snap")
    W.snapshots(snap.withColumn("ds", F.lit("2024-01-02")), f"{tmp_path}/snap")
    assert spark.read.parquet(f"{tmp_path}/snap").count() == 2
    assert R.or_earlier(df.limit(0), df).count() == 1 and R.or_earlier(df, df.limit(0)).count() == 1


def test_boundary():
    calls = []

    def flaky(row):
        calls.append(1)
        e = ConnectionError("x")
        e.status_code = 503
        if len(calls) < 3:
            raise e
        return {"ok": 1}

    waits = []
    assert outcome(retried(flaky, sleep=waits.append), {}) == {"ok": 1} and len(calls) == 3 and waits == [0.5, 1.0]

    def late(row):
        raise TimeoutError

    assert outcome(late, {}) == {"error": "Timeout"}
    assert outcome(page_double({}), {"url": "x"}) == {"error": "HTTP Error: 404", "status_code": 404}
    assert outcome(lambda row: 1 / 0, {})["error"].startswith("Unexpected Error")


def test_day(spark, tmp_path):
    data = [(1, 1, "https://a.pe/n1", "c1"), (2, 1, "https://a.pe/n1", "c2"), (3, 1, "https://a.pe/gone", "c"), (4, 2, "https://a.pe/img/1.png", "c"), (5, 2, "https://www.facebook.com/p", "c"), (6, 2, "https://old.pe/x", "c"), (7, 2, None, None)]
    links = spark.createDataFrame(data, "link_no int, page int, url string, context string")
    hist = spark.createDataFrame([("https://old.pe/x",)], "url string")
    page = {"https://a.pe/n1": {"page_html": "<title>T</title><p>agua y saneamiento</p>", "content_type": "text/html"}}
    run = P.run_day(links, hist, page_double(page), lambda r: {"filepath": "/f", "filename": "f", "content_type": "image/png", "size": 3}, lambda r: {"extracted_text": "hola"}, lambda r: {"pdf_path": "/p", "success": True, "extracted_text": "t"}, "01042025")
    assert {r.url: (r.error, r.title, r.relevance) for r in run.pages.collect()} == {"https://a.pe/n1": (None, "T", 0.4), "https://a.pe/gone": ("HTTP Error: 404", None, None)}
    assert run.history.count() == 5
    s = run.stats.first()
    assert (s.total_urls, s.new_urls, s.html_processing.relevant, s.image_processing.successful_text, s.social_processing.extracted_texts) == (7, 5, 1, 1, 1)
    P.store(run, str(tmp_path), "01042025")
    doc = json.loads(spark.read.text(f"{tmp_path}/output/consolidated_01042025.json").first()[0])
    assert len(doc["extracted_content"]["html_pages"]) == 2
    again = P.run_day(links, run.history, page_double(page), *[lambda r: {}] * 3, "02042025")
    assert again.links.count() == 0 and again.stats.first().html_processing.average_relevance == 0.0


def test_command_runs_a_range(spark, tmp_path, monkeypatch, capsys):
    (tmp_path / "In").mkdir()
    for day, url in (("01042025", "https://a.pe/img/1.png"), ("03042025", "https://a.pe/img/2.png")):
        (tmp_path / "In" / f"links_extracted_{day}.csv").write_text(f'Page,URL,Rect,Context\n1,{url},,c\n1,https://a.pe/img/1.png,,c\n')
    (tmp_path / "outer_world.py").write_text(
        "fetch = capture = lambda r: {}\n"
        "download = lambda r: {'filepath': r['url'][-5:], 'filename': 'f', 'content_type': 'image/png', 'size': 3}\n"
        "recognise = lambda r: {'extracted_text': 'hola ' + r['filepath']}\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "outer_world.py"))
    assert P.main([str(tmp_path), "01042025", "--until", "03042025", "--boundaries", "outer_world"]) == 0
    assert capsys.readouterr().out.split() == ["01042025", "done", "02042025", "CSV", "not", "found", "03042025", "done"]
    assert sorted(r.url for r in spark.read.parquet(f"{tmp_path}/History/v=2").collect()) == ["https://a.pe/img/1.png", "https://a.pe/img/2.png"]
    assert spark.read.parquet(f"{tmp_path}/Cache/v=2").count() == 2
    texts = spark.read.json(f"{tmp_path}/Images/downloads/03042025/image_texts.json").collect()
    assert [(r.url, r.extracted_text) for r in texts] == [("https://a.pe/img/2.png", "hola 2.png")]


def test_stream_equals_batch(spark, tmp_path):
    data = [(i, i // 4, f"u{i % 7}", None) for i in range(20)]
    df = spark.createDataFrame(data, I.LINKS)
    for k in range(3):
        df.where(f"link_id % 3 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    I.new_links(I.link_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out/links")
    assert sorted(r.url for r in out.collect()) == [f"u{i}" for i in range(7)]


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(f) for f in entry.queries().values())
