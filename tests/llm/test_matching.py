import random
import re
import uuid

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressglean.llm import p03_near_duplicates as p3
from pressglean.llm import p04_scans as p4
from pressglean.llm import p07_history as p7
from pressglean.llm import p08_packing as p8
from pressglean.llm import p09_leaks as p9
from pressglean.runtime import shared_dir


def jaccard_pairs(texts, width, threshold, least):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if t is not None and len(w) >= max(1, least):
            sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9}


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        k = rng.randrange(len(w))
        w[k : k + rng.choice((0, 1))] = [f"x{rng.randrange(999)}"]
    return w


def test_p3_against_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(60)]
    texts, i = [], 0
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(5, 150))]
        for n in (0, 0, 3, 12, 30)[: rng.randint(1, 5)]:
            i += 1
            texts.append((i, " ".join(edited(rng, base, n)).replace("x", "X, ")))
    texts += [(900, None), (901, ""), (902, "uno"), (903, "uno"), (904, " ".join(f"z{k}" for k in range(12000))), (905, " ".join(f"z{k}" for k in range(100, 12000)))]
    df = spark.createDataFrame(texts, "page_id long, text string").withColumn("class", F.lit(1)).withColumn("norm", F.lit(1))
    for width, threshold, least in ((3, 0.5, 1), (5, 0.8, 10)):
        members, links = p3.near_duplicates([(df, "page_id", "text")], width, threshold, least)
        want = jaccard_pairs(texts, width, threshold, least)
        assert {(r.id_a, r.id_b) for r in p3.expanded_pairs(members, links).collect()} == want
        counts = {r.id: r.links for r in p3.near_duplicate_classes(members, links).collect()}
        assert all(n == sum(i in pair for pair in want) for i, n in counts.items())
    members, links = p3.near_duplicates([(df.limit(0), "page_id", "text")])
    assert p3.expanded_pairs(members, links).count() == 0


def test_p3_hot_shingles_meet_once_in_cells(monkeypatch):
    monkeypatch.setattr(p3, "HOT", 7)
    classes = np.arange(50, dtype=np.int64) * 7919
    n = len(classes)
    h, o, p, c = np.full(n, 5, np.uint64), np.arange(n, dtype=np.uint32), np.zeros(n, np.uint32), np.full(n, 50)
    h2, o2, _ = p3._in_cells(h, o, p, c, np.arange(n), classes)
    met = {}
    for key in np.unique(h2):
        own = sorted(set(o2[h2 == key]))
        for x in own:
            for y in own:
                if x < y:
                    met[x, y] = met.get((x, y), 0) + 1
    assert len(met) == n * (n - 1) // 2


def test_p3_shuffle_does_not_grow_with_buckets(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice("abcdefghijk") + str(rng.randrange(300)) for _ in range(400))) for i in range(60)]
    docs = p3.prepared(spark.createDataFrame(texts, "page_id long, text string"), "page_id", "text", 0)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    few, many = (p3._packed(docs.coalesce(1), none, 3, 60, 0.5, n).agg(F.sum(F.length("payload"))).first()[0] for n in (12, 400))
    assert many < 2.5 * few


def test_p3_many_buckets_and_parts(spark, monkeypatch):
    monkeypatch.setattr(p3, "BUCKET", 300)
    monkeypatch.setattr(p3, "PART", 7)
    rng = random.Random(5)
    texts, i = [], 0
    for _ in range(25):
        base = [f"w{rng.randrange(70)}" for _ in range(rng.randint(10, 90))]
        for n in (0, 0, 4, 9):
            i += 1
            texts.append((i, " ".join(edited(rng, base, n))))
    members, links = p3.near_duplicates([(spark.createDataFrame(texts, "page_id long, text string"), "page_id", "text")], 3, 0.5, 5)
    assert {(r.id_a, r.id_b) for r in p3.expanded_pairs(members, links).collect()} == jaccard_pairs(texts, 3, 0.5, 5)


def test_p3_classes_with_the_same_short_form():
    sets = [np.arange(1, 41, dtype=np.uint64) * np.uint64(977), np.arange(5, 45, dtype=np.uint64) * np.uint64(977), np.arange(900, 940, dtype=np.uint64) * np.uint64(977)]
    classes = np.array([7, 8, 7 + (1 << 32)], dtype=np.int64)
    packed = p3._packed_classes(classes, sets)
    owner, pos = np.repeat(np.arange(3, dtype=np.uint32), 21), np.tile(np.arange(21, dtype=np.uint32), 3)
    payload = p3._packed_prefixes(p3._short(classes), np.concatenate([g[:21] for g in sets]), owner, pos)
    a, b = p3.bucket_pairs([payload], lambda: [packed], 0.5)
    assert {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())} == {(7, 8)}


def test_p3_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (7, 9), (20, 21)], "a long, b long")
    got = {r.node: r.root for r in p3.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


LINKS = [
    (1, 1, "http://WWW.Sitio.example:80/a/"), (2, 1, "https://sitio.example/a#x"), (3, 1, "https://sitio.example/A"), (4, 1, None), (5, 1, " "), (6, 1, "mailto:x@y"), (7, 2, "https://sitio.example/a?utm_source=z&fbclid=1"), (8, 2, "https://sitio.example/a?b=1&a=2"),
    (9, 2, "https://sitio.example/a?a=2&b=1"), (10, 2, "https://sitio.example/a?a=2&b=3"), (11, 3, "https://sitio.example/x/titulo-largo-1000001"), (12, 3, "https://sitio.example/y/otro-1000001/?q=1"), (13, 3, "https://otro.example/y/otro-1000001"), (14, 3, "https://sitio.example/opini%C3%B3n"),
    (15, 3, "https://sitio.example/opinión"), (16, 3, "https://sitio.example/o%70ini%c3%b3n/"), (17, 3, "https://m.sitio.example/a"), (18, 4, "https://viejo.example/z"), (19, 4, "https://sitio.example/a%2Fb"), (20, 4, "https://sitio.example/a/b"), (21, 4, "https://sitio.example/nota-12345"), (22, 4, "https://sitio.example/otra-12345"),
]
SEEN = {2, 7, 9, 12, 15, 16, 18}


def test_p7_in_one_call_and_batch_by_batch(spark):
    links = spark.createDataFrame(LINKS, "link_id long, batch_no int, url string").withColumn("address", F.lit("x")).withColumn("id", F.lit(0))
    hist = spark.createDataFrame([("http://www.viejo.example/z/",), (None,), ("",)], "url string")
    for parts in ([links], [links.where(f"batch_no = {b}") for b in (1, 2, 3, 4)]):
        store = p7.seeded_store(hist, f"{shared_dir(spark)}/{uuid.uuid4().hex}", buckets=4, most=2)
        got = [r for part in parts for r in p7.checked_links(part, store).collect()]
        assert {r.id for r in got if r.is_new is False} == SEEN
        assert {r.id for r in got if r.is_new is None} == {4, 5, 6} and len(got) == len(LINKS)
    before = p7.checked_links(links.where("link_id in (1, 18)"), store).collect()
    store.merge()
    assert len(store.generations()) == 1
    assert all(r.is_new is False for r in before) and all(r.is_new is False for r in p7.checked_links(links.where("link_id in (1, 18)"), store).collect())
    assert p7.checked_links(links.limit(0), store).count() == 0


def test_p7_runs_give_what_batches_give(spark):
    links = spark.createDataFrame(LINKS, "link_id long, batch_no int, url string")
    hist = spark.createDataFrame([("http://www.viejo.example/z/",)], "url string")
    store = p7.seeded_store(hist, f"{shared_dir(spark)}/{uuid.uuid4().hex}", buckets=4)
    got = p7.checked_links(links, store, runs=3).collect()
    assert {r.id for r in got if r.is_new is False} == SEEN and len(got) == len(LINKS)


def test_p7_reads_only_the_buckets_of_positives(spark):
    hist = spark.range(5_000).select(F.concat(F.lit("https://sitio.example/nota/"), "id").alias("url"))
    store = p7.seeded_store(hist, f"{shared_dir(spark)}/{uuid.uuid4().hex}", buckets=64)
    batch = spark.createDataFrame([("https://sitio.example/nota/7",), ("http://www.sitio.example/nota/9/",), *((f"https://otro.example/{i}",) for i in range(200))], "url string")
    keyed = store.keyed(batch.select(p7.address_of(F.col("url")).alias("address"), F.lit(None).cast("bigint").alias("first")))
    screened = store.prescreened(keyed).collect()
    positives = {r.address for r in screened if r.maybe}
    assert {"sitio.example/nota/7", "sitio.example/nota/9"} <= positives and len(positives) <= 12
    touched = sorted({r.bucket for r in screened if r.maybe})
    read = store.looked_up(touched)
    assert 0 < read.count() < 5_000 * (len(touched) + 4) / 64
    # the filter prunes folders: it isn't one on rows that were read
    assert "bucket" in read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]
    assert sorted(r[0] for r in store.known(store.prescreened(keyed)).collect()) == ["sitio.example/nota/7", "sitio.example/nota/9"]


def test_p8_limits_and_fill():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 300, 800)
    loss = np.minimum(tokens, rng.integers(0, 300, 800))
    for segments, share in ((1000, 1.0), (3, 1.0), (1000, 0.5), (4, 0.4)):
        t, los = tokens, np.minimum(loss, int(300 * share))
        where = p8.pack(t, los, 300, segments, int(300 * share))
        assert (where >= 0).all()
        assert np.bincount(where, weights=t).max() <= 300 and np.bincount(where).max() <= segments and np.bincount(where, weights=los).max() <= int(300 * share)
    where = p8.pack(tokens, tokens, 300, 1000, 300)
    assert tokens.sum() / ((where.max() + 1) * 300) > 0.98


def test_p8_tables(spark):
    docs = spark.createDataFrame([(1, "agua " * 700, "t"), (2, "agua", None), (3, "", "t"), (4, None, "t"), (2, "agua", None)], "doc_id long, text string, title string").withColumn("tokens", F.lit("x"))
    limits = [(1, 256), (2, 4096)]
    sizes = p8.token_sizes(docs, "doc_id", "text")
    got = p8.packed(sizes, limits)
    total = {r.id: r.tokens for r in sizes.collect()}
    pieces = got.groupBy("limit_id", "doc_id").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r.limit_id, r.doc_id, r.n) for r in pieces} == {(1, 1, -(-total[1] // 256)), (1, 2, 2), (2, 1, 1), (2, 2, 2)}
    assert all(r.t == total[r.doc_id] * (2 if r.doc_id == 2 else 1) for r in pieces)
    assert all(r.fullest <= r.capacity for r in p8.packing_report(got, limits).collect())
    tight = p8.packed(p8.token_sizes(docs, "doc_id", "text", "title"), limits, max_segments=1, loss_share=0.5)
    assert tight.groupBy("limit_id", "container_id").agg(F.sum("loss").alias("s")).where("s > 128 and limit_id = 1").count() == 0
    assert p8.packed(sizes.limit(0), limits).count() == 0


def test_p8_long_texts_count_exactly():
    with open(p8.VOCABULARY, "rb") as f:
        count = p8.token_counter(f.read())
    text = "El agua, según S/ 12,345.  Fin\n\nde la nota " * 3000
    whole = count(text)
    old, p8.STRETCH = p8.STRETCH, 500
    try:
        assert count(text) == whole
    finally:
        p8.STRETCH = old


WORD = st.sampled_from("agua río Ñandú canal 12 obra é".split())


@settings(max_examples=60, deadline=None)
@given(st.lists(WORD, min_size=0, max_size=40), st.lists(WORD, min_size=12, max_size=40), st.integers(2, 6))
def test_p9_scanner_equals_brute_force(doc, passage, least):
    text, item = "  ".join(doc), ", ".join(passage)
    d, p = p9.words_of(text), p9.words_of(item)
    best = 0
    for a in range(len(d)):
        for b in range(len(p)):
            n = 0
            while a + n < len(d) and b + n < len(p) and d[a + n] == p[b + n]:
                n += 1
            best = max(best, n)
    got = p9._scanner([(1, "passage", item)], least)(text)
    assert [g[2] for g in got] == ([best] if best >= least else [])
    assert all(p9.words_of(text[g[3] : g[4]]) == d[k : k + g[2]] for g in got for k in [next(k for k in range(len(d)) if d[k : k + g[2]] == p9.words_of(text[g[3] : g[4]]))])


def test_p9_tables(spark):
    p = "Uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce"
    items = spark.createDataFrame([(1, p, "corta", "B"), (2, None, None, None), (None, p, p, "A")], "item_id long, passage string, question string, answer string")
    docs = spark.createDataFrame([(1, "x " + p.upper().replace(" ", "\n- ") + " y", 5), (2, " ".join(p.split()[:11]), 5), (3, None, 5), (4, "", 5), (1, p, 5)], "doc_id long, text string, words int")
    got = p9.leaks(docs, items)
    assert sorted((r.doc_id, r.item_id, r.words) for r in got.collect()) == [(1, 1, 14), (1, 1, 14)]
    assert [tuple(r) for r in p9.leak_report(got).collect()] == [(1, 1, "passage", 14)]
    assert p9.leaks(docs.limit(0), items).count() == 0 and p9.leaks(docs, items.limit(0)).count() == 0


def scan(rng, n, noise):
    words = "la junta de usuarios del valle informó que la reparación del sifón quedará lista en el distrito según el gobierno regional mantenimiento consumo medida demanda".split()
    lines, page = [], 10 + n % 5
    for k in range(12):
        if k % 6 == 0:
            lines += [f"- {page + k // 6} -", "Correo Serrano   REGIONES"]
        lines.append(" ".join(rng.choice(words) for _ in range(8)))
    lines[3] = lines[3] + " repa-"
    lines[4] = "ración " + lines[4]
    for k, extra in (noise or {}).items():
        lines[k] += extra
    return "\n".join(lines)


#: Misreadings of several words by a few kinds of error, so that there is something to learn from.
NOISE = ["g0bierno", "inf0rmó", "c0nsumo", "rnantenimiento", "consurno", "rnedida", "list@", "junt@", "medid@", "clistrito", "clemanda", "medicla", "vlale", "sufión", "junat"]


def noisy_scans(rng, n=160):
    return [(i, scan(rng, i, {5: " " + NOISE[i // 3 % len(NOISE)]} if i % 3 == 0 else None)) for i in range(n)]


def test_p4_defects_and_repair(spark):
    rng = random.Random(4)
    odd = {5: " g0bierno", 6: " medid@ informó", 11: " COVID-19 l723 rcgional"}
    rows = noisy_scans(rng) + [(500, scan(rng, 1, None)), (502, scan(rng, 2, odd)), (90_000, None), (90_001, ""), (90_002, " \n")]
    df = spark.createDataFrame([*rows, rows[-5]], "image_id long, extracted_text string").withColumn("text", F.lit("t")).withColumn("id", F.lit(1))
    got = {}
    found = p4.read_defects(df).collect()
    assert len(found) == len(set(found))
    for r in found:
        got.setdefault(r.id, set()).add((r.line_no, r.defect))
    base = {(1, "page_number"), (2, "header"), (9, "page_number"), (10, "header"), (4, "hyphen")}
    assert got[500] == base and not {90_000, 90_001, 90_002} & set(got)
    assert got[502] - base == {(6, "misread"), (7, "misread"), (12, "misread")}
    assert all(got[i] >= base for i in range(160))
    assert sum((6, "misread") in got[i] for i in range(0, 160, 3)) >= 50
    text = {r.id: r.text for r in p4.read_repaired(df).collect()}
    assert "reparación" in text[502] and "repa-" not in text[502] and "REGIONES" not in text[502] and "gobierno" in text[502] and "1723" in text[502] and "COVID-19" in text[502]
    assert p4.read_defects(df.limit(0)).count() == 0 and p4.read_repaired(df.limit(0)).count() == 0


def test_p4_untrained_editor_finds_little(spark, monkeypatch):
    df = spark.createDataFrame(noisy_scans(random.Random(5)), "image_id long, extracted_text string")
    count = lambda: p4.read_defects(df).where("defect in ('misread', 'hyphen')").count()
    trained = count()
    monkeypatch.setattr(p4, "fitted_editor", lambda words: p4.CharEditor())
    assert trained > 180 and count() < trained / 2


def test_p4_editor_on_held_out_noise():
    """Errors learned from some words are undone in others."""
    words = "reparación gobierno regional municipalidad distrital saneamiento tubería reservorio comisión vivienda denuncia informe vecinos plazo obras contrato temporada estiaje demanda medida consumo".split()
    errors = {"o": ["0"], "a": ["@"], "m": ["rn"], "d": ["cl"], "": ["S"]}
    rng = random.Random(99)
    seen, frequent = {}, {w: 1000 for w in words}
    for w in words[:14]:
        for _ in range(6):
            s, labels = p4.noised(w, errors, rng)
            if s != w:
                assert p4.applied(s, [(i, x) for i, x in enumerate(labels) if x != "K"]) == w
                seen[s] = 2
    editor = p4.trained_editor(frequent, seen)
    tries = [(w, s) for w in words[14:] for _ in range(8) for s, _ in [p4.noised(w, errors, rng)] if s != w]
    right = sum(bool(rs) and rs[0][0] == w for (w, s), rs in zip(tries, editor.edits([s for _, s in tries])))
    assert right >= 0.85 * len(tries), [(w, s, rs[:2]) for (w, s), rs in zip(tries, editor.edits([s for _, s in tries])) if not rs or rs[0][0] != w]
    assert not any(rs and rs[0][1] > 0 for rs in editor.edits(words))
    joined = [editor.line_end(w[:4] + "-", w[4:]) for w in words if len(w) > 6]
    assert sum(x == (True, False) for x in joined) >= 0.9 * len(joined) and not editor.line_end(" -", "medida")[0]
    assert p4.CharEditor().edits(words) == [[]] * len(words)


def test_p4_misread_words_that_recur(spark):
    rng = random.Random(6)
    rows = [(i, t + "\nel acuerdo con el servicio de la costa\nsin acuerdo hasta el acuerdo con el servicio") for i, t in noisy_scans(rng)]
    # the same errors in many scans; "costa" and "carta" are words of their own
    rows += [(1000 + i, scan(rng, i, None) + "\nacuerclo del distrito\nserv1ci0 del distrito\nAcuerclo y carta del valle\nuna carta de la costa") for i in range(6)]
    df = spark.createDataFrame(rows, "image_id long, extracted_text string")
    last = {i: len(t.split("\n")) for i, t in rows}
    got = {(r.id, r.line_no) for r in p4.read_defects(df).where("defect = 'misread'").collect() if r.id >= 1000}
    assert {(i, last[i] - k) for i in range(1000, 1006) for k in (1, 3)} <= got and not any((i, last[i]) in got for i in range(1000, 1006))
    text = {r.id: r.text for r in p4.read_repaired(df).collect()}[1000]
    assert "acuerclo" not in text.lower() and "Acuerdo y carta del valle" in text


def test_p9_short_questions_and_answers(spark):
    far = " palabra" * 80
    items = spark.createDataFrame([(1, None, "¿Qué río abastece a Lima?", "El Rímac")], "item_id long, passage string, question string, answer string")
    docs = spark.createDataFrame([(1, "Pregunta: ¿QUE RIO abastece a Lima? Respuesta: el Rimac."), (2, "el Rímac crece"), (3, "¿Qué río abastece a Lima?" + far + " el Rímac"), (4, "qué río abastece a Piura")], "doc_id long, text string")
    got = sorted((r.doc_id, r.field, r.words) for r in p9.leaks(docs, items).collect())
    assert got == [(1, "answer", 2), (1, "question", 5), (3, "question", 5)]
    assert [tuple(r) for r in p9.leak_report(p9.leaks(docs, items)).collect()] == [(1, 2, "answer,question", 5)]
