import random
import time

import pytest
from pyspark.sql import functions as F

from pressglean.llm import p01_site_lines as p1
from pressglean.llm import p02_residue as p2
from pressglean.llm import p05_main_content as p5
from pressglean.llm import p06_encoding as p6
from pressglean.llm import p10_truncated as p10

PAGES = "page_id long, url string, ds string, title string, text string, id string, key string"


def pages(spark, rows):
    """(id, url, ds, title, text); with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_p1_counts_records_and_clusters(spark):
    u = "https://WWW.Sitio.example/n"
    rows = [(i, u, f"2024-01-0{i}", None, f"Aviso  legal {i}\n\ntexto propio {'abcdef'[i]}{i}x") for i in range(1, 6)]
    rows += [(10 + i, u, "2024-01-09", None, "Nota repetida\nigual") for i in range(6)]
    rows += [(20, "https://otro.example/", "2024-01-01", None, "Aviso legal 1"), (21, None, None, None, "Aviso legal 1"), (22, u, None, None, None), (23, u, None, None, ""), (24, u, None, None, " \n ")]
    df = pages(spark, rows)
    got = sorted((r.id, r.line_no) for r in p1.repeated_lines(df, min_records=5).collect())
    assert got == sorted([(i, 1) for i in range(1, 6)] + [(10 + i, n) for i in range(6) for n in (1, 2)])
    clean = {r.page_id: (r.text, r.removed) for r in p1.without_repeated_lines(df).collect()}
    assert clean[1] == ("\ntexto propio b1x", 1) and clean[10] == ("Nota repetida\nigual", 0)
    assert clean[22] == (None, 0) and clean[23] == ("", 0) and len(clean) == len(rows)
    assert p1.repeated_lines(df.limit(0)).count() == 0 and p1.without_repeated_lines(df.limit(0)).count() == 0


def test_p1_records_alone_make_no_clusters(spark, monkeypatch):
    def unused(*_):
        raise AssertionError("clusters decide nothing here")

    u = "https://sitio.example/n"
    rows = [(i, u, "2024-01-01", None, f"Copia\nCopia\notra {'abcdefg'[i]}") for i in range(3)] + [(10 + i, u, "2024-01-02", None, "Copia\nigual") for i in range(2)]
    df = pages(spark, rows)
    several = p1.repeated_lines(df, min_records=5, min_clusters=4)
    assert {(r.id, r.line_no, r.records, r.clusters) for r in several.collect()} == {(i, n, 5, 4) for i in range(3) for n in (1, 2)} | {(10 + i, 1, 5, 4) for i in range(2)}
    monkeypatch.setattr(p1, "line_support", unused)
    got = p1.repeated_lines(df.drop("ds"), min_records=5)
    assert got.columns == ["id", "line_no", "records"]
    assert {tuple(r) for r in got.collect()} == {(i, n, 5) for i in range(3) for n in (1, 2)} | {(10 + i, 1, 5) for i in range(2)}


def test_p1_articles_published_again_stay(spark):
    body = "La comisión de vivienda informó que la obra del reservorio sigue pendiente\nVecinos de la zona alta reclamaron por la demora de la entrega del proyecto"
    rows = [(i, "https://d.example/x", f"2024-01-0{i}", None, f"Menú del diario\n{body}\nLateral {'abcdefg'[i]}") for i in range(1, 7)]
    rows += [(10 + i, "https://d.example/y", f"2024-02-0{i}", None, f"Menú del diario\nOtra nota {'abcdefg'[i]} de la sección que habla de un tema bien distinto al de las demás {'hijklmn'[i]}") for i in range(1, 7)]
    clean = {r.page_id: (r.text, r.removed) for r in p1.without_repeated_lines(pages(spark, rows)).collect()}
    assert all(clean[i] == (f"{body}\nLateral {'abcdefg'[i]}", 1) for i in range(1, 7)) and all(clean[10 + i][1] == 1 for i in range(1, 7))


def test_p1_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, f"https://s{rng.choice('aab')}.example/{i}", "2024-01-01", None, "\n".join(rng.choice(["Uno", " uno\t", "dos 12", "dos  7", "tres", "", f"p{i}"]) for _ in range(6))) for i in range(60)]
    norm = lambda s: __import__("re").sub(r"\d+", "0", " ".join(s.split()).lower())
    held = {}
    for i, u, _, _, t in rows:
        for line in t.split("\n"):
            held.setdefault((u.split("/")[2], norm(line)), set()).add(i)
    want = sorted((i, n) for i, u, _, _, t in rows for n, line in enumerate(t.split("\n"), 1) if norm(line) and len(held[u.split("/")[2], norm(line)]) >= 5)
    assert sorted((r.id, r.line_no) for r in p1.repeated_lines(pages(spark, rows), 5).collect()) == want


ARTICLE = "La municipalidad distrital anunció la obra del reservorio para atender a los vecinos de la zona. " * 12


@pytest.mark.parametrize(
    ("text", "out"),
    [
        ("{{ nota.titulo }}\n{% for p in x %}{{ p }}{% endfor %}", True), (ARTICLE + "según ${monto} soles", True), (ARTICLE + "dijo __NOMBRE__ ayer", True), (ARTICLE + "[COMPLETAR CIFRA] obras", True),
        (ARTICLE + "el TK TK regional", True), (ARTICLE + "[object Object]", True), (ARTICLE + "{cargo} regional y {0} más", True), (ARTICLE + "%%FECHA%%", True), (ARTICLE + "<%= distrito %>", True), (ARTICLE + "<<autor>>", True), (ARTICLE + "@@LUGAR@@", True),
        (ARTICLE + "La fórmula {a + b} del anexo [47] se corrigió [sic].", False), (ARTICLE + "usó «{{nombre}}» como ejemplo y `${x}` en el código", False), (ARTICLE + "exige habilitar JavaScript para ver el recibo", False), (ARTICLE + "un «lorem ipsum» como broma", False),
        (ARTICLE, False), ("Error 404\nLa página que busca no existe", True), ("Error al establecer la conexión con la base de datos", True), ("Please turn them on and reload.", True), ("Noticia breve y completa sobre el agua.", False),
        ("Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore", True), ("Ejemplo asdf ficticio línea columna borrador lista aquí muestra qwerty maqueta bloque contenido prueba texto", True), ("", False),
    ],
)
def test_p2_cases(spark, text, out):
    assert p2.residue(pages(spark, [(1, None, None, None, text)])).first().exclude is out


NAV = "\n".join(f"Sección {'abcdefghij'[i % 10]} Economía Política Deportes" for i in range(40))


@pytest.mark.parametrize(
    ("text", "out"),
    [
        ("La nueva planta de tratamiento está en construcción y abastecerá a 4.000 familias del distrito desde el próximo año, dijo el alcalde.", False),
        ("El servicio no disponible durante el martes por tareas de mantenimiento en la red se repondrá por la noche en los seis sectores.", False),
        ("Vecinos reclamaron por el acceso restringido al reservorio que abastece a las comunidades de la parte alta del valle.", False),
        ("Sitio en construcción", True), ("Acceso denegado.\nVuelva al inicio", True), ("Error 404\nLa página que busca no existe\n" + NAV, True),
        (ARTICLE + "En el tutorial se explica la plantilla: con {{ nombre }} se pone el nombre", False), ((ARTICLE + "La plantilla usa una sintaxis de llaves. Así va {{ nombre }} en el texto. ") * 3, False), (ARTICLE + "Hola {{ nombre }}, gracias", True),
    ],
)
def test_p2_context_and_prose(spark, text, out):
    assert p2.residue(pages(spark, [(1, None, None, None, text)])).first().exclude is out


def test_p2_nulls(spark):
    df = pages(spark, [(1, None, None, None, None), (2, None, None, None, "${x}"), (2, None, None, None, "${x}")])
    assert [r.id for r in p2.residue(df).where("exclude").collect()] == [2, 2] and p2.residue(df.limit(0)).count() == 0


def site_page(i, extra=""):
    para = f"En el sector {i}, la comisión {'abcdefgh'[i % 8]} informó que el plan número {i * 7} sigue pendiente de aprobación en la zona."
    return "\n".join(["Inicio | Deportes | Economía", f"Obras en la zona {'abcdefghij'[i]} avanzan según el informe de los vecinos", "Por Ana Rojas", para, "", "Lee más: Alertan desde Lima retrasos en las obras del colector", para.replace("plan", "proyecto") + " Fin.", f"- Medida {'abcdefgh'[i % 8]} de la zona", extra, "Compartir en redes", "Últimas noticias", "Otra nota de la sección sobre el mismo tema de siempre", "© 2024 Diario. Todos los derechos reservados."])


def test_p5_finds_furniture(spark):
    rows = [(i, "https://www.d.example/x", None, f"Obras en la zona {'abcdefghij'[i]} avanzan según el informe de los vecinos | Diario", site_page(i)) for i in range(8)]
    rows += [(50, "https://www.d.example/x", None, "t", None), (51, None, None, None, ""), (52, "https://e.example", None, "", "Error 404\nNo encontrada"), (53, None, None, None, "Un solo párrafo sin título que habla del agua y de la obra pendiente en la zona alta.")]
    got = {r.id: (r.lines, r.kept) for r in p5.outside_article(pages(spark, rows)).collect()}
    assert set(got) == {*range(8), 53}
    assert got[3] == ([1, 3, 6, 10, 11, 12, 13], [2, 4, 7, 8]) and got[53] == ([], [1])
    text = {r.page_id: r.text for r in p5.main_content(pages(spark, rows)).collect()}
    assert text[3].startswith("Obras en la zona d") and "Lee más" not in text[3]
    assert p5.outside_article(pages(spark, rows).limit(0)).count() == 0


def test_p5_classes_are_ordered_and_nested(spark):
    def keys(footer, classes=True):
        rows = [(i, "https://www.d.example/x", None, None, "\n".join([f"Titular propio {'abcd'[i]} de la nota sobre el agua", f"Párrafo de la nota {'efgh'[i]} con lo que pasó en la zona alta de la ciudad.", *footer(i)])) for i in range(4)]
        f = p5.page_features(pages(spark, rows), "page_id", "text", "url", "title").cache()
        return p5.template(f, classes=classes).count()

    steady = lambda i: ["Barra de la casa", "Pie de la casa", f"Uno {'xyzw'[i]} cosa"]
    turned = lambda i: ["Barra de la casa", "Pie de la casa"][:: 1 if i % 2 else -1]
    alone = lambda i: ["Barra de la casa"]
    assert keys(steady) == 2 and keys(steady, False) == 0 and keys(turned) == 0 and keys(alone) == 0


def test_p5_lengthy_notice(spark):
    notice = "Este medio informa a quienes lo visitan que el uso de sus páginas está sujeto a las reglas que se detallan en el documento que cada persona puede pedir en la sede central de lunes a viernes por la mañana o por la tarde, sin costo alguno para ella y sin más trámite que el de presentar su solicitud por escrito."
    texts = [site_page(i % 8).replace("Lee más", notice + "\nLee más").replace("número ", f"número {'abcdefghijklmnopqrst'[i // 2]}") for i in range(40)]
    rows = [(i, "https://www.d.example/x", None, None, t) for i, t in enumerate(texts)]
    assert len(notice) > 295
    got = p5.outside_article(pages(spark, rows)).collect()
    assert len(got) == 40 and all(texts[r.id].split("\n").index(notice) + 1 in r.lines for r in got)


def test_p6_round_trips():
    clean = "El niño pidió más agua: «¿Cuánto costará?», según la región Ñuñoa y São Paulo. La firma Åkerblöm & Müßig cotizó £ 14 por m³ según el Nº 2; Δ = 45 ½ y «ВОДА»."
    assert p6.restored(clean) == (clean, [], 0)
    base = "El niño pidió más agua: «¿Cuánto costará?», según la región."
    for enc in ("cp1252", "cp437", "cp850", "mac_roman", "cp1251"):
        raw = base.encode("utf-8")
        garbled = raw.decode("latin-1") if enc == "cp1252" else raw.decode(enc, errors="strict") if enc != "cp1251" else raw.decode("cp1251", errors="replace")
        fixed, chain, lost = p6.restored(garbled)
        assert (chain or lost) and (enc == "cp1251" or fixed == base)
    twice = base.encode().decode("latin-1").encode().decode("latin-1")
    assert p6.restored(twice)[0] == base
    swapped = "El padrón según Quispe".encode("cp1252").decode("mac_roman")
    assert p6.restored(swapped)[:2] == ("El padrón según Quispe", ["mac_roman>cp1252"])
    assert p6.restored("La comisi�n inform")[2] == 1 and p6.restored("la comisi?n inform")[2] == 1
    assert p6.restored("está en /consulta?exp=852 y /pagos?ruc=1")[2] == 0


def test_p6_long_runs_take_linear_time():
    began = time.time()
    chinese = "水资源管理局今天宣布新的供水计划" * 6_250
    assert p6.restored(chinese) == (chinese, [], 0)
    assert p6.restored("A9" * 50_000)[0] == "A9" * 50_000 and p6.restored("a—bc" * 25_000)[2] == 0 and p6.restored("«?" * 50_000)[2] >= 0
    garbled = (chinese[:2_000] + "ñandú").encode().decode("latin-1")
    assert p6.restored(garbled)[0] == chinese[:2_000] + "ñandú"
    assert time.time() - began < 20


def test_p6_many_layers():
    deep = "región"
    for _ in range(7):
        deep = deep.encode().decode("latin-1")
    assert p6.restored(deep)[0] == "región"


def test_p6_table(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "rÃ\xado", 0), (3, "rÃ\xado", 0), (4, "río", 0)], "link_id long, context string, lost int")
    assert sorted((r.id, r.text) for r in p6.repaired(df, "link_id", "context").collect()) == [(3, "río"), (3, "río")]
    assert p6.repaired(df.limit(0), "link_id", "context").count() == 0


def test_p10_limits_and_closings(spark):
    rng = random.Random(5)
    rows, i = [], 0
    words = "agua obra zona plan vecinos comité región sector informe caudal red tubería servicio".split()
    sentence = lambda: (" ".join(rng.choice(words) for _ in range(rng.randint(6, 12)))).capitalize() + "."
    for _ in range(60):
        text = " ".join(sentence() for _ in range(8))
        i += 1
        rows.append((i, text if i % 2 else text[:200], "corta" if i % 2 == 0 else "larga"))
    whole = [(100, "Uno va. Dos va.\nCon información de la red", "x"), (101, "Uno va.\nContinuará…", "x"), (102, "Uno va.", None), (103, None, "x"), (104, "  ", "x"), (105, "Va bien. ¿Qué pasará con la obra?", "x")]
    whole += [(200 + k, sentence() + "\nCon información de la red", "x") for k in range(8)] + [(300 + k, sentence() + "\nContinuará…", "y") for k in range(8)]
    cut = [(400, "Uno va. El comité de la zo... Leer más", "x"), (401, "Uno va. El comité de la zo�", "x"), (402, "Uno va. El comité [...]", "x"), (403, "Sin embargo,", "x")]
    df = spark.createDataFrame(rows + whole + cut, "doc_id long, text string, source string").withColumn("id", F.lit("z"))
    got = {r.id: r for r in p10.judged(df).collect()}
    assert all(not got[k].truncated for k, t, _ in whole if t and t.strip()) and 103 not in got and 104 not in got
    assert all(got[k].truncated for k, _, _ in cut)
    assert all(got[k].truncated and got[k].at_limit for k, t, s in rows if s == "corta" and not t.rstrip().endswith("."))
    assert all(not got[k].truncated for k, t, s in rows if s == "larga")
    share = {r.source: r.truncated for r in p10.truncation_by_source(df).collect()}
    assert share["larga"] == 0 and share["corta"] > 20
    assert p10.judged(df.limit(0)).count() == 0


def test_p6_prefilter_passes_what_is_restored(spark):
    words = "costará asumir demandará Sorcustolén región día año según José qué río niño ¿qué «región» ÁREA Ñuñoa EXPLICÓ".split()
    texts = {"costar·", "SorcustolÚn", "regi—n", "d¡a", "Lima — Callao", "agua—dijo"}
    for wrong, right in p6.SWAPS:
        for w in words:
            try:
                texts.add(w.encode(right).decode(wrong))
            except UnicodeError:
                pass
    df = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts))], "link_id long, context string")
    passed = {r.context for r in df.where(p6.suspicious(F.col("context"))).collect()}
    changed = {t for t in texts if p6.restored(t)[1] or p6.restored(t)[2]}
    assert changed <= passed and {"costar·", "SorcustolÚn", "regi—n", "d¡a"} <= changed
    assert [p6.restored(t)[0] for t in ("costar·", "SorcustolÚn", "regi—n", "d¡a", "agua—dijo")] == ["costará", "Sorcustolén", "región", "día", "agua—dijo"]
