import json
from datetime import date, datetime

from pressglean.plans import queries as Q


def test_backlog_reads_up_to_the_last_batch(spark, tmp_path):
    u = "https://www.facebook.com/p/{}"
    rows = [(1, 3, u.format("a")), (2, 11, u.format("b")), (3, 12, u.format("c")), (4, 12, u.format("a")), (5, 11, u.format("b")), (6, 11, u.format("h"))]
    spark.createDataFrame(rows, "link_id long, batch_no int, url string").write.parquet(f"{tmp_path}/links_extracted.parquet")
    spark.createDataFrame([(u.format("h"),)], "url string").write.parquet(f"{tmp_path}/url_history.parquet")
    assert [tuple(r) for r in Q.social_backlog_last(spark, str(tmp_path)).collect()] == [(2, u.format("b"))]


def test_consolidated_gives_every_day(spark, tmp_path):
    a, b = date(2024, 3, 1), date(2024, 3, 2)
    tables = {
        "links_extracted": ([(1, b, "https://sitio.example/n")], "link_id long, ds date, url string"),
        "scraped_texts": ([(1, a, "u", "t", "x", 0.5, None), (2, b, "u", "t", "y", 0.1, None), (3, b, "v", "t", "z", 0.9, "e")], "page_id long, ds date, url string, title string, text string, relevance double, error string"),
        "image_links": ([(1, "f", datetime(2024, 3, 2, 5), None), (2, None, None, "e")], "image_id long, filepath string, download_timestamp timestamp, error string"),
        "image_api_results": ([(1, "i", "02032024", "texto", None)], "image_id long, image_filename string, processed_date string, extracted_text string, error string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.ds: json.loads(r.document) for r in Q.run_consolidated(spark, str(tmp_path)).collect()}
    assert set(got) == {a, b, None}
    assert got[b]["metadata"]["html_processing"]["attempted"] == 2 and got[b]["metadata"]["image_processing"] == {"attempted_download": 1, "successful_download": 1, "attempted_text": 1, "successful_text": 1}
    assert sum(got[b]["metadata"]["categories"].values()) == 1 and [p["page_id"] for p in got[b]["extracted_content"]["html_pages"]] == [2, 3]
    assert [p["page_id"] for p in got[a]["extracted_content"]["html_pages"]] == [1] and got[None]["metadata"]["image_processing"]["attempted_download"] == 1
