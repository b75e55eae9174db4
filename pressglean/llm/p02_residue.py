"""Template residue, filler and error pages among scraped texts.

Unfilled placeholders are found by one grammar per delimiter, after code blocks, inline code and quoted
examples are taken out, and marks beside words about templates: a sentence that explains a mark isn't unfilled.
Where such words are dense, the text is about templates and its marks don't count at all. Error, access and script
notices count only where there is little running prose besides, however long the menus around them are; wordings
that articles use too count only in short sentences. Filler counts where it makes up the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grammars of unfilled placeholders as (character that must occur, pattern).
NAME = r"[\p{L}_][\p{L}\p{Nd}_.\-]*"
PLACEHOLDERS: tuple[tuple[str, str], ...] = (
    ("{", r"\{\{\{?[#/>&!^]?\s*" + NAME + r"(?:\s+" + NAME + r"|\s*\|\s*[\w:'\" ]+)*\s*\}?\}\}"),
    ("{", r"\{%-?\s*[a-z]+[^%{}\n]*-?%\}"),
    ("{", r"[$#]\{\s*" + NAME + r"\s*\}"),
    ("{", r"(?<![\{\$#\p{L}\p{Nd}])\{[?:=@]?(?:" + NAME + r"|\p{Nd}{1,2})\}(?!\})"),
    ("%", r"%%\s*" + NAME + r"\s*%%|(?<![\p{Nd}%])%" + r"[A-ZÁÉÍÓÚÑ_]{3,}%(?!%)"),
    ("@", r"@@\s*" + NAME + r"\s*@@"),
    ("<", r"<%[=\-@]?\s*[\p{L}_][^%\n]*%>|<\?(?:php|=)[^?\n]*\?>"),
    ("<", r"<<\s*" + NAME + r"\s*>>"),
    ("[", r"\[\[\s*" + NAME + r"(?:[ _]" + NAME + r"){0,3}\s*\]\]"),
    ("[", r"\[(?iU:complet(?:ar|e|ado)|insert(?:ar|e|a)?|escrib(?:ir|a|e)|agreg(?:ar|ue)|añad(?:ir|a)|reemplaz(?:ar|e|a)|poner|ponga|coloc(?:ar|que)|indi(?:car|que)|ingres(?:ar|e)|redact(?:ar|e)|defin(?:ir|a)|verific(?:ar|que)|pendiente(?: de)?|your|add|enter|preencher|inserir|substitu(?:ir|a))\s[^\[\]\n]{2,60}\]"),
    ("[", r"\[object Object\]"),
    ("_", r"(?<![\p{L}_])__[A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ_\p{Nd}]*__(?![\p{L}_])"),
    ("X", r"(?<![\p{L}\p{Nd}])X{4,}(?![\p{L}\p{Nd}])"),
    ("T", r"(?<![\p{L}])TK TK(?![\p{L}])|(?<![\p{L}])(?:TODO|FIXME|TBD)\s*:"),
)
# Words that announce a formula or set in braces rather than a placeholder.
MATHS_RE = r"(?iU)(?:fórmula|expresión|conjunto|intervalo|ecuación|formula|set)\s+(?:de\s+)?[{\[]"
# Code and quoted examples.
CODE_RE = r"(?s)```.*?```|`[^`\n]{1,200}`|<(code|pre)\b[^>]*>.*?</\1>|(?<=[«“\"'])\s*[{\[<%@$#_]{1,3}[^«»“”\"'\n]{1,60}[}\]>%@_]{1,3}\s*(?=[»”\"'])"
# Words about templates, which make a mark in their sentence an example.
TALK = r"(?:plantillas?|templates?|marcador(?:es)?|placeholders?|sintaxis|syntax|llaves|corchetes|tutorial(?:es)?|jinja|mustache|handlebars|motor de vistas|campo de combinaci[óo]n|merge fields?)"
TALK_RE = rf"(?iU)\b{TALK}\b"
NEAR_TALK_RE = rf"(?iU)\b{TALK}\b[^\n.!?]*?[{{\[<%@$#_]{{1,3}}[^\n{{}}\[\]<>]*[}}\]>%@_]{{1,3}}[^\n.!?]*|[{{\[<%@$#_]{{1,3}}[^\n{{}}\[\]<>]*[}}\]>%@_]{{1,3}}[^\n.!?]*?\b{TALK}\b"
# Messages of errors, access checks and scripts, in lower case. Each stands for itself in a text without an article.
NOTICES = (
    r"(?:habilit|activ|permit)\w* (?:el |los |las )?(?:uso de )?(?:javascript|scripts|cookies)", r"(?:enable|turn on|activate|allow) (?:javascript|scripts|cookies)", r"requires? (?:javascript|scripts|cookies)", r"javascript (?:is )?(?:disabled|required|desactivado|deshabilitado|desabilitado)",
    r"noscript", r"turn them on and reload", r"navegador no es compatible", r"browser is not supported|unsupported browser", r"\b(?:ative|habilite) o javascript",
    r"\b(?:error|erro|código|code|http)(?: http)?:? ?[45]\d\d\b", r"^[\s\W]*[45]\d\d\b", r"not found", r"internal server error", r"bad gateway", r"service unavailable", r"gateway time-?out", r"access denied", r"forbidden", r"unexpected condition", r"permission to access",
    r"página (?:que busca )?no (?:existe|encontrada|disponible)", r"no (?:encontramos|se encontró|se ha encontrado|pudimos encontrar)", r"página não encontrada", r"no existe o fue movida", r"ya no está disponible", r"enlace ha caducado",
    r"vuelva (?:a intentarlo|en unos minutos|más tarde)", r"inténtelo (?:de nuevo|más tarde)", r"try again later",
    r"demasiadas solicitudes", r"too many requests", r"límite de consultas", r"inicie sesión", r"suscríbase para (?:continuar|seguir)", r"sign in to continue|log in to continue", r"subscribe to (?:continue|read)",
    r"no es un robot", r"not a robot", r"verif\w+ (?:que|su|your|you)\b.{0,40}(?:robot|humano|human|conexión|connection|navegador|browser)", r"captcha", r"checking your browser", r"comprobamos su conexión", r"just a moment", r"ray id",
    r"fatal error", r"undefined variable", r"uncaught \w+", r"stack trace|traceback", r"null given", r"exception in ", r"syntax error", r"sql error|mysql_", r"error (?:de|al|en) (?:la |el )?(?:establecer |abrir )?(?:la |el )?(?:conexión|conectar\w*|servidor|base de datos)", r"database (?:error|connection)", r"sesión (?:ha )?(?:expirado|caducado)", r"session (?:has )?expired", r"redireccionando|redirecting",
    r"hello world", r"welcome to your (?:new )?site", r"texto de (?:ejemplo|prueba|relleno)", r"sample (?:page|text|post)", r"reemplácelo por su contenido", r"título de la entrada", r"^[\s\W]*(?:undefined|null|nan)[\s\W]*$", r"\bundefined\b",
)
# Wordings of notices that articles use too.
SHORT_NOTICES = (
    r"servicio no disponible", r"tareas de mantenimiento", r"em manutenção", r"under (?:maintenance|construction)", r"en construcción", r"acceso (?:restringido|denegado|prohibido)", r"contenido (?:solicitado |no )", r"contenido restringido",
)
NOTICE_RE = "(?mU)" + "|".join(NOTICES)
#: A short sentence: at most ten words between punctuation or line ends.
SHORT_RE = r"(?U)(?:^|[\n.!?:;])[^\p{L}\p{Nd}\n]*(?:[\p{L}\p{Nd}]+[^\p{L}\p{Nd}\n.!?:;]+){0,5}?(?:" + "|".join(SHORT_NOTICES) + r")(?:[^\p{L}\p{Nd}\n.!?:;]+[\p{L}\p{Nd}]+){0,5}\s*(?:\n|[.!?:;](?=\s|$)|$)"
#: Lines that aren't running prose: short ones, and those without the end of a sentence.
NO_PROSE_RE = r"(?m)^.{0,45}$|^[^.!?\n]*$"
# Words of the usual Latin filler and of dummy texts. Each list is counted by itself.
LATIN = "lorem ipsum dolor amet consectetur adipiscing adipisicing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum sit id est et in ut ea ad ex qui non do"
DUMMY = "asdf qwerty blabla bla ejemplo ficticio borrador maqueta relleno simulado provisional prueba muestra párrafo bloque columna línea lista texto contenido noticia diseño redactar pendiente siguiente aquí va irá esté cuando el la de dummy placeholder sample exemplo teste rascunho"
#: Words of which one must occur before the lists are counted.
FILLER_SIGNS = r"(?i)lorem|ipsum|consectetur|adipisc|eiusmod|incididunt|cillum|cupidatat|excepteur|asdf|qwerty|blabla|dummy"
FILLER_RES = tuple(r"(?iU)\b(?:" + "|".join(words.split()) + r")\b" for words in (LATIN, DUMMY))


def without_code(text: Column) -> Column:
    """`text` without code blocks, inline code and quoted examples of marks."""
    return F.when(text.rlike(r"[`«“\"']|<(?:code|pre)"), F.regexp_replace(text, CODE_RE, " ")).otherwise(text)


def placeholder_marks(text: Column) -> Column:
    """Whether a placeholder stands unfilled outside of code and formulas."""
    bare = F.regexp_replace(without_code(text), MATHS_RE + r"[^}\]]*[}\]]", " ")
    talk = F.size(F.regexp_extract_all(text, F.lit(TALK_RE), F.lit(0)))
    bare = F.when(~text.rlike(TALK_RE), bare).when((talk >= 3) & (talk * 80 >= F.size(F.split(text, r"\s+"))), F.lit("")).otherwise(F.regexp_replace(bare, NEAR_TALK_RE, " "))
    marks = F.transform(F.array(bare), lambda b: reduce(lambda x, y: x | y, [F.contains(b, F.lit(ch)) & b.rlike(pattern) for ch, pattern in PLACEHOLDERS]))
    return F.when(text.rlike(r"[{%@<\[]|__|XXXX|TK TK|(?:TODO|FIXME|TBD)\s*:"), marks[0]).otherwise(False)


def _notice(text: Column, article_words: int) -> Column:
    def little_prose(prose: Column) -> Column:
        words = F.size(F.split(F.trim(F.regexp_replace(prose, r"(?U)[^\p{L}\p{Nd}]+", " ")), " "))
        # only short prose is split into words
        return F.when(F.length(prose) < article_words * 12, words < article_words).otherwise(False)

    few = F.transform(F.array(F.regexp_replace(text, NO_PROSE_RE, "")), little_prose)[0]
    low = F.lower(text)
    return F.when(few, low.rlike(NOTICE_RE) | low.rlike(SHORT_RE)).otherwise(False)


def _filler(text: Column, filler_words: int, filler_share: float) -> Column:
    def much(pattern: str) -> Column:
        count = F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        return F.transform(F.array(count), lambda n: (n >= filler_words) & (n >= filler_share * F.size(F.split(text, r"\s+"))))[0]

    return F.when(text.rlike(FILLER_SIGNS), much(FILLER_RES[0]) | much(FILLER_RES[1])).otherwise(False)


def no_article(text: Column, article_words: int = 110, filler_words: int = 12, filler_share: float = 0.35) -> Column:
    """Whether the text is a notice, a bare template or filler instead of an article."""
    return _notice(text, article_words) | _filler(text, filler_words, filler_share)


def residue(pages: DataFrame, id_col: str = "page_id", text_col: str = "text", article_words: int = 110, filler_words: int = 12, filler_share: float = 0.35) -> DataFrame:
    """(id, placeholder, notice, filler, exclude) of each record with a text.

    notice: an error, access or script message beside fewer than `article_words` words of running prose (lines of
    more than 45 characters in which a sentence ends). filler: at least `filler_words` words of filler making up `filler_share` of the words.
    NULL texts give no row; empty or blank ones no flag at all. Rows are judged one by one whatever repeats,
    extra columns are ignored, an empty table gives an empty result.
    """
    p = pages.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    out = p.select("id", placeholder_marks(F.col("text")).alias("placeholder"), _notice(F.col("text"), article_words).alias("notice"), _filler(F.col("text"), filler_words, filler_share).alias("filler"))
    return out.withColumn("exclude", F.col("placeholder") | F.col("notice") | F.col("filler"))
