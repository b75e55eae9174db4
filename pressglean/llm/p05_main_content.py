"""Main content of pages: template deduction over the pages of one host.

Each line gives tokens: the line itself, the line with names and numbers as slots, and its lead up to a
delimiter. Tokens of a host that occur equally often in the very same pages share an occurrence vector and form an
equivalence class. A class is valid if it has several tokens, enough distinct documents and one order of all its
tokens in every document; the valid class of most documents is the host's root, and another is nested in the
template if it lies within one and the same gap of the root in all documents. Tokens of nested classes make up the
template; so do tokens of support enough by themselves, which most furniture has, and fixed wordings, which hold on
every host. The template splits a page into slots; the article is the slot between its headline and its last paragraph or list line,
without the template lines, bylines, dates, links and marks nested in it.

Texts are read once; all later stages work on 64-bit tokens and counts.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressglean.llm.common import site_of
from pressglean.llm.p02_residue import no_article
from pressglean.runtime import small_side, written

PARA, LIST, OTHER, BLANK = 1, 2, 3, 0
#: Marks in a line's kind: worded like furniture; so long that it is more likely a paragraph.
WORDED, LENGTHY = 8, 16
#: Characters of a lengthy line, whose token is a digest of it as it stands but for letter case. Copies of an article with small edits share such lines, so they need a share of the host's pages.
LONG = 220

# Leads and wordings of what isn't article, in lower case, for lines of a single page.
LINK_RE = re.compile(r"^(?:\W{0,3}(?:lee|lea|leer|mira|mire|ver|vea|conoce|conozca|leia|veja|read|see)\b(?: también| además| más| mais| também| more| also| tambi\S*)*|te puede interesar|le puede interesar|podría interesar\w*|relacionad[oa]s?|no te pierdas|además|related(?: story| news)?|también en este medio|nota relacionada|noticia relacionada|aviso de servicio|publirreportaje|contenido patrocinado)\s*[:»›>|\]-]\s*\S")
ASIDE_RE = re.compile(r"^[»›→▸►]\s*\S|^\[(?:además|lea|lee|ver|mira|relacionado|también|publicidad|anuncio|aviso)[^\]]*\]")
COMMENT_RE = re.compile(r"^@\w[\w .'-]{1,50}(?:\s*[»:>-]|\s*$)|^\w+ \w+(?: \w+)? (?:escribió|dice|comentó|opina|respondió|wrote|says|disse|escreveu)\s*:|^(?:usuario|lector|anónimo|invitado|comentario de)\b[^.]{0,40}[:»]")
NAMES = r"[A-ZÁÉÍÓÚÑ][\w'’-]+(?: (?:de|del|la|los|y|[A-ZÁÉÍÓÚÑ][\w'’-]+)){0,4}"
BYLINE_RE = re.compile(rf"^(?:(?i:por|texto|escribe|escrito por|redacción|redacci\S+n|redactor\w*|autor\w*|foto\w*|by|fotos?|edición|corresponsal|reportaje|informa|texto y fotos)\s*[:|]?\s+{NAMES}|{NAMES}\s*[|/·–-]\s*(?i:corresponsal|redacci\S*|redactor\w*|periodista|editor\w*|reporter\w*|enviad[oa] especial)|@{NAMES})(?:\s*\([^)]*\))?[.]?$")
MONTH = r"(?:ene|feb|mar|abr|may|jun|jul|ago|set|sep|oct|nov|dic|jan|apr|aug|dec|fev|out|dez)[a-zç]*"
DATE_RE = re.compile(rf"^(?:(?:publicad\w*|actualizad\w*|fecha|posted|updated|publicaci\S+n|últim\w+ actualizaci\S+n|atualizado|hace)\b.{{0,40}}\d|(?:(?:lunes|martes|mi\S?rcoles|jueves|viernes|s\S?bado|domingo)\W+)?\d{{1,2}}(?:[/.-]\d{{1,2}}[/.-]\d{{2,4}}|\s+(?:de\s+)?{MONTH}(?:\s+(?:de\s+)?\d{{4}})?)\b.{{0,22}}$|\d{{4}}-\d\d-\d\d\b.{{0,16}}$|{MONTH}\s+\d{{1,2}},\s*\d{{4}}.{{0,16}}$|\d{{1,2}}:\d\d\s*(?:h|hrs|am|pm)?\.?$)")
MARK_RE = re.compile(
    r"^\W*(?:publicidad|anuncio|advertisement|espacio publicitario|publicidade|patrocinado|sigue leyendo.*|continúa leyendo.*|compart\w+ (?:en redes|esta|este|la|\d).*|compart(?:ir|e)\W*$|compartido \d+ veces|comparte esta nota.*|share\b.{0,40}|¿te gustó.*|imprimir\b.*|enviar por correo.*|guardar|síguenos\b.*|suscríb\w+.{0,60}|recibe nuestro\b.*|lectura de \d+ min\w*|\d+ min\w* de lectura|tiempo de lectura.*|\d+ (?:comentarios?|comments?|vistas|lecturas|reacciones)|comentarios?(?: \(\d+\))?|deja (?:un|tu) comentario.*|tendencias|lo más (?:leído|visto|popular)|últimas noticias|más (?:noticias|de esta sección|en .{0,30})|noticias relacionadas|te puede interesar|temas relacionados|también te puede.*|volver (?:al inicio|arriba)|ir al contenido|menú)\W*$"
)
TAGS_RE = re.compile(r"^(?:etiquetas?|tags?|temas?|palabras clave|keywords|categor\S+as?|assuntos|tópicos|archivado en)\s*:\s*\S|^#\s?\w[^.]*$")
NOTICE_RE = re.compile(r"\bcookies?\b|\bprivacidad\b|\bprivacy\b|todos los derechos reservados|all rights reserved|derechos de autor|reproducción total o parcial|términos y condiciones|libro de reclamaciones|responsabilidad de quien(?:es)? los? emite|usted consiente el|almacenamiento de datos en su|publicación inscrita en el registro|^director\w* (?:fundador|general|responsable)\w*\s*:|^dise\S+o y desarrollo|^dirección\s*:.*\bcentral\b|^central\s*:|^©|\bcopyright\b|editado por grupo")
SEPARATED_RE = re.compile(r"\s[|·›•»/]\s")
NAME_RE = re.compile(r"\b[A-ZÁÉÍÓÚÑ][a-zñáéíóúüç]{2,}\b")
DIGITS_RE = re.compile(r"\d+")
LEAD_RE = re.compile(r"^(.{2,40}?(?:[:»›\]|]|escribió:|dice:))\s+\S")
BULLET_RE = re.compile(r"^(?:[-–*•▪◦‣]\s+|\d{1,2}[.)]\s+)\S")
END_RE = re.compile(r"[.!?…][\"'”’»)\]]*$|»$")


def _menu(line: str) -> bool:
    """Short capitalised items in a row: a menu, a path or a list of sections."""
    parts = SEPARATED_RE.split(line)
    if len(parts) >= 2:
        return all(len(p) <= 32 and len(p.split()) <= 5 for p in parts) and not END_RE.search(line)
    words = line.split()
    return words[0].lower() in ("menú", "menu", "secciones") and len(words) > 1


def furniture_wording(line: str) -> bool:
    """Whether the wording of a single line alone says that it isn't article."""
    low = line.lower()
    return bool(
        MARK_RE.search(low) or DATE_RE.search(low) or TAGS_RE.search(low) or LINK_RE.search(low) or ASIDE_RE.search(low) or COMMENT_RE.search(low) or _menu(line) or BYLINE_RE.search(line) or (len(line) < LONG and NOTICE_RE.search(low))
    )


def line_features(text: str, title: str | None) -> tuple[list[int], list[str], list[str], list[str], int]:
    """(kind, whole, framed, lead, head) of the lines: kind is PARA, LIST, OTHER or BLANK, plus WORDED if the
    wording is that of furniture and LENGTHY; the tokens are '' where a line has none; head is the headline's position or -1."""
    raw = text.split("\n")
    kinds, whole, framed, lead = [], [], [], []
    want = " ".join((title or "").split()).lower()
    head = first = -1
    for i, r in enumerate(raw):
        line = " ".join(r.split())
        if not line:
            kinds.append(BLANK), whole.append(""), framed.append(""), lead.append("")
            continue
        n = len(line)
        ends = END_RE.search(line) is not None
        bullet = BULLET_RE.match(line) is not None
        if n >= LONG:
            odd = COMMENT_RE.search(line[:100].lower()) or LINK_RE.search(line[:60].lower())
            kinds.append((LIST if bullet else PARA) + LENGTHY + (WORDED if odd else 0)), whole.append(blake2b(line.lower().encode(), digest_size=8).hexdigest()), framed.append(""), lead.append("")
            if first < 0 and not odd:
                first = i
            continue
        worded = furniture_wording(line)
        kind = LIST if bullet and not worded else PARA if ends and n >= 45 else OTHER
        if not worded:
            low = line.lower()
            if head < 0 and len(want) > 14 and n > 14 and (want.startswith(low) or low.startswith(want)):
                head = i
            if first < 0 and len(line.split()) >= 4:
                first = i
        kinds.append(kind + (WORDED if worded else 0))
        masked = DIGITS_RE.sub("0", line)
        whole.append(masked.lower())
        frame = NAME_RE.sub("N", masked) if kind == OTHER else ""
        framed.append(frame)
        m = LEAD_RE.match(frame) if kind == OTHER else None
        lead.append(m.group(1) if m else "")
    return kinds, whole, framed, lead, head if head >= 0 else first


def _hashes(site: list[str], tokens: list[str], salt: str) -> np.ndarray:
    """64-bit token keys, 0 for no token."""
    if not tokens:
        return np.zeros(0, dtype=np.int64)
    keys = np.array([f"{salt}{s}\t{t}" if t else "" for s, t in zip(site, tokens)], dtype=object)
    codes, vocab = pd.factorize(keys)
    h = pd.util.hash_array(np.asarray(vocab, dtype=object), categorize=False).view(np.int64).copy()
    h[np.asarray(vocab, dtype=object) == ""] = 0
    return h[codes]


def page_features(pages: DataFrame, id_col: str, text_col: str, url_col: str, title_col: str) -> DataFrame:
    """(id, site, doc, kinds, whole, framed, lead, head, tail) of pages that hold an article: tokens and positions only."""
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(site_of(F.col(url_col)), F.lit("")).alias("site"), F.col(title_col).alias("title"), F.col(text_col).alias("text"))
    p = p.where(F.col("text").isNotNull() & ~no_article(F.col("text")))

    def op(batches):
        for b in batches:
            ids, sites, titles, texts = (b.column(i).to_pylist() for i in range(4))
            kinds, tokens, lens, heads, owner = [], ([], [], []), [], [], []
            for site, title, text in zip(sites, titles, texts):
                k, w, f, le, head = line_features(text, title)
                kinds += k
                for t, part in zip(tokens, (w, f, le)):
                    t += part
                lens.append(len(k)), heads.append(head), owner.extend([site] * len(k))
            offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
            hashed = [_hashes(owner, t, salt) for t, salt in zip(tokens, "wfl")]
            docs = pd.util.hash_array(np.array([s + "\t" + " ".join(t.split()) for s, t in zip(sites, texts)], dtype=object), categorize=False).view(np.int64)
            arrays = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(h)) for h in hashed]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sites, pa.string()), pa.array(docs), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.array(kinds, dtype=np.int32))), *arrays, pa.array(heads, pa.int32())], ["id", "site", "doc", "kinds", "whole", "framed", "lead", "head"]
            )

    return p.mapInArrow(op, "id bigint, site string, doc bigint, kinds array<int>, whole array<bigint>, framed array<bigint>, lead array<bigint>, head int")


def _body(kind):
    return (kind.bitwiseAND(F.lit(WORDED)) == 0) & (kind % 8).isin(PARA, LIST)


def _occurrences(docs: DataFrame) -> DataFrame:
    """(site, doc, pos, at, outside, level, key): the tokens of each line; level 0 lines, 1 framed, 2 leads, 3 lengthy lines."""
    last = F.array_max(F.transform("kinds", lambda k, i: F.when(_body(k), i).otherwise(-1)))
    flat = docs.withColumn("last", last).select("site", "doc", "head", "last", F.size("kinds").alias("n"), F.posexplode(F.arrays_zip("kinds", "whole", "framed", "lead")).alias("pos", "l"))
    outside = ((F.col("pos") < F.col("head")) | (F.col("pos") > F.col("last"))).cast("int")
    level = F.when(F.col("l.kinds") >= LENGTHY, 3).otherwise(0)
    token = F.explode(F.array(F.struct(level.alias("level"), F.col("l.whole").alias("key")), F.struct(F.lit(1).alias("level"), F.col("l.framed").alias("key")), F.struct(F.lit(2).alias("level"), F.col("l.lead").alias("key"))))
    return flat.select("site", "doc", "pos", (F.col("pos") / F.col("n")).alias("at"), outside.alias("outside"), token.alias("t")).select("site", "doc", "pos", "at", "outside", "t.*").where("key <> 0")


def nested_classes(tokens: DataFrame, occurrences: DataFrame, class_support: int) -> DataFrame:
    """(class) of the valid equivalence classes that nest in their host's template.

    `tokens` has (site, key, docs, class); a class is valid if its tokens, two or more on lines of their own, stand
    in one order in each of at least `class_support` documents.
    """
    rows = occurrences.join(tokens.select("key", "docs", "class"), "key").groupBy("site", "class", "docs", "doc", "key").agg(F.min("pos").alias("pos"))
    each = rows.groupBy("site", "class", "docs", "doc").agg(F.array_sort(F.collect_list(F.struct("pos", "key"))).alias("seq"))
    each = each.select("site", "class", "docs", "doc", F.xxhash64("seq.key").alias("sequence"), F.array_distinct("seq.pos").alias("spots"))
    each = written(each, "p5-classes")
    valid = each.groupBy("site", "class", "docs").agg(F.count_distinct("sequence").alias("sequences"), F.min(F.size("spots")).alias("lines")).where((F.col("sequences") == 1) & (F.col("lines") >= 2) & (F.col("docs") >= class_support))
    root = valid.groupBy("site").agg(F.max(F.struct("docs", "class")).alias("r")).select("site", F.col("r.class").alias("class"))
    roots = each.join(root, ["site", "class"]).select("site", "doc", F.col("class").alias("root"), F.col("spots").alias("root_spots"))
    placed = each.join(valid.select("site", "class"), ["site", "class"]).join(roots, ["site", "doc"], "left")
    gap = lambda end: F.size(F.filter("root_spots", lambda p: p < end("spots")))
    placed = placed.select("class", (F.col("class") == F.col("root")).alias("is_root"), gap(F.array_min).alias("before"), gap(F.array_max).alias("behind"), F.col("root").isNotNull().alias("beside"))
    gaps = placed.groupBy("class").agg(F.max("is_root").alias("is_root"), F.count_distinct(F.when(F.col("beside"), F.col("before"))).alias("gaps"), F.count_if(F.col("beside") & (F.col("before") != F.col("behind"))).alias("astride"))
    return gaps.where(F.coalesce("is_root", F.lit(False)) | ((F.col("gaps") <= 1) & (F.col("astride") == 0))).select("class")


def template(features: DataFrame, support: int = 5, class_support: int = 3, within: float = 0.03, lengthy: float = 0.3, classes: bool = True) -> DataFrame:
    """(key): the tokens that make up the hosts' templates.

    Copies within a host count once. A token's occurrence vector is summed up in its document count and the sum of
    hashes of its documents with its number there; tokens with one vector form a class (see `nested_classes`). A
    token alone needs `support` documents. Slotted tokens (framed and lead) must stand outside the article's slot
    in most of their documents, whole lines there or in a share `within` of the host's documents, lengthy lines in
    a share `lengthy`. Without `classes` only tokens of support enough by themselves count.
    """
    docs = features.groupBy("site", "doc").agg(F.first(F.struct("kinds", "whole", "framed", "lead", "head")).alias("f")).select("site", "doc", "f.*")
    sized = docs.groupBy("site").agg(F.count(F.lit(1)).alias("site_docs"))
    occurrences = _occurrences(docs)
    # the page as a whole: a token may occur on several lines, its document counts once
    keys = occurrences.groupBy("site", "key", "level", "doc").agg(F.count(F.lit(1)).alias("times"), F.max("outside").alias("outside"))
    tokens = keys.groupBy("site", "key", "level").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.xxhash64("doc", "times").cast("decimal(20,0)")).alias("vector"), F.avg("outside").alias("outside")
    ).where(F.col("docs") >= class_support)
    tokens = written(tokens.withColumn("class", F.xxhash64("site", "docs", "vector")), "p5-tokens")
    enough = F.col("docs") >= support
    if classes:
        several = tokens.groupBy("class").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("class")
        nested = nested_classes(small_side(tokens.select("key", "docs", "class").join(several, "class", "left_semi"), "p5-members"), occurrences, class_support)
        tokens = tokens.join(nested.withColumn("nested", F.lit(True)), "class", "left")
        enough |= F.coalesce("nested", F.lit(False))
    t = tokens.join(sized, "site")
    slotted = F.when(F.col("level").isin(1, 2), (F.col("docs") >= support) & (F.col("outside") >= 0.6)).otherwise(True)
    # copies with small edits share subheads, lists and paragraphs: what stands within the article's slot must be common on the host
    common = (F.col("docs") >= support) & (F.col("docs") >= F.when(F.col("level") == 3, lengthy).otherwise(within) * F.col("site_docs"))
    placed = common | ((F.col("level") < 3) & (F.col("outside") >= 0.6))
    return t.where(enough & slotted & placed).select("key").distinct()


def outside_article(pages: DataFrame, id_col: str = "page_id", text_col: str = "text", url_col: str = "url", title_col: str = "title") -> DataFrame:
    """(id, lines, kept): the numbers of the non-blank lines that aren't article, and of those that are.

    Records that hold no article (NULL or blank text, error pages, filler, menus alone) give no row. Pages
    without a host are treated as one host; a NULL or empty title leaves the first full line as headline;
    rows that repeat an id and its text come out once; an empty table gives an empty result.
    """
    features = written(page_features(pages, id_col, text_col, url_col, title_col), "p5-features")
    marks = small_side(template(features), "p5-template")
    rows = features.select("id", "doc", "head", F.posexplode(F.arrays_zip("kinds", "whole", "framed", "lead")).alias("pos", "l")).where("l.kinds > 0")
    keys = F.filter(F.array("l.whole", "l.framed", "l.lead"), lambda k: k != 0)
    rows = rows.select("id", "doc", "head", "pos", F.col("l.kinds").alias("kind"), F.explode_outer(keys).alias("key"))
    rows = rows.join(marks.withColumn("hit", F.lit(True)), "key", "left")
    hit = F.coalesce("hit", F.lit(False))
    # a headline stays one, however often it is listed elsewhere
    rows = rows.select("id", "doc", "head", "pos", (F.col("kind") % 8).alias("kind"), ((F.col("kind").bitwiseAND(F.lit(WORDED)) > 0) | (hit & (F.col("pos") != F.col("head")))).alias("off"))
    page = rows.groupBy("id", "doc").agg(F.first("head").alias("head"), F.collect_set(F.struct("pos", "kind", "off")).alias("all"))
    # a line stands here once as on and once as off if only some of its tokens are in the template
    taken = F.array_distinct(F.transform(F.filter("all", lambda x: x["off"]), lambda x: x["pos"]))
    page = page.withColumn("taken", taken).withColumn("ls", F.filter("all", lambda x: x["off"] | ~F.array_contains("taken", x["pos"])))
    body = F.filter("ls", lambda x: ~x["off"] & ((x["kind"] == PARA) | (x["kind"] == LIST)) & (x["pos"] >= F.col("head")))
    page = page.withColumn("last", F.array_max(F.transform(body, lambda x: x["pos"]))).where("last is not null")
    away = lambda x: x["off"] | (x["pos"] < F.col("head")) | (x["pos"] > F.col("last"))
    numbers = lambda keep: F.array_sort(F.transform(F.filter("ls", keep), lambda x: (x["pos"] + 1).cast("int")))
    return page.select("id", numbers(away).alias("lines"), numbers(lambda x: ~away(x)).alias("kept"))


def main_content(pages: DataFrame, id_col: str = "page_id", text_col: str = "text", **cols: str) -> DataFrame:
    """(id, text): the article of each page that holds one."""
    found = outside_article(pages, id_col, text_col, **cols)
    texts = pages.select(F.col(id_col).alias("id"), F.split(text_col, "\n").alias("ls")).join(found.select("id", "kept"), "id")
    return texts.select(F.col("id").alias(id_col), F.array_join(F.transform("kept", lambda i: F.element_at("ls", i)), "\n").alias("text"))
