"""Column functions over markdown text. All are built-in expressions but for ``parse_frontmatter``."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the markdown format: section headers, labels of a protocol, sentence words of a row.
TAKEAWAYS_HEADER = r"Puntos\s+Clave|Conclusiones\s+clave|Hallazgos\s+Clave"
PROTOCOLS_HEADER = r"Herramientas\s+y\s+Protocolos"
OVERVIEW_HEADER = r"Resumen del Episodio|Descripci[oó]n general del episodio"
RESOURCES_HEADER = r"Recursos(?:\s+Mencionados)?"
PROTOCOL_LABELS = (("Que", "Qu[eé]"), ("Como", "C[oó]mo"), ("Cuando", "Cu[aá]ndo"))

# White space and the characters that end a line, as the format's own parser takes them.
BLANK = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
NOT_LINE_END = r"[^\n\r\u2028\u2029]"


def _accented() -> tuple[str, str]:
    """Lower-case letters that decompose into a plain letter or digit and marks of U+0300 to U+036F, and the plain ones."""
    found = {}
    for code in range(0x80, 0x10000):
        bare = [c for c in unicodedata.normalize("NFD", chr(code)) if not "\u0300" <= c <= "\u036f"]
        if len(bare) == 1 and bare[0].isascii() and (bare[0].islower() or bare[0].isdigit()):
            found[chr(code)] = bare[0]
    return "".join(found), "".join(found.values())


_ACCENTED, _PLAIN = _accented()

#: Greetings and thanks that need no retrieval.
SMALL_TALK = ("hola", "hi", "hello", "hey", "buenas", "buenos dias", "gracias", "thanks", "thank you", "ok", "adios", "bye", "salut", "hallo", "danke", "merci")


def filled(c: Column, default: Column | str | None = None) -> Column:
    """``c``, or the default where it is null or empty."""
    default = F.lit(default) if default is None or isinstance(default, str) else default
    return F.coalesce(F.nullif(c, F.lit("")), default)


def default_topic(c: Column, value: str = "general", only_null: bool = False) -> Column:
    """Ingest takes empty topics as missing too; queries replace null only."""
    return F.coalesce(c, F.lit(value)) if only_null else filled(c, value)


def trimmed(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+\z", "")


def slugify(c: Column, limit: int = 40) -> Column:
    """Lower-case, accents dropped, other runs to single dashes, cut; empty gives ``general``."""
    plain = F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), _ACCENTED, _PLAIN), r"[̀-ͯ]", "")
    dashed = F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9]+", "-"), r"^-+|-+\z", "")
    return filled(F.substring(dashed, 1, limit), "general")


def strip_inline(c: Column, headings: bool = False) -> Column:
    """Drops time links and bold marks (and heading marks), makes runs of blanks one space, trims.

    A lone newline stays."""
    out = F.regexp_replace(c, r"\[(?:\d{2}:\d{2}:\d{2}|\d{2}:\d{2})\]\([^)]*\)", "")
    out = F.regexp_replace(out, r"\*\*", "")
    if headings:
        out = F.regexp_replace(out, r"#{1,4}\s*", "")
    return F.regexp_replace(F.regexp_replace(out, r"(?U)\s{2,}", " "), r"(?U)^\s+|\s+\z", "")


def extract_section(c: Column, pattern: str) -> Column:
    """Body of the first ``##`` section whose header matches; empty if none does. Sub-headers do not end it."""
    return F.regexp_extract(c, r"(?iu)##\s*(?:" + pattern + r")[^\r\n]*\r?\n([\s\S]*?)(?=\r?\n##\s|\z)", 1)


def parse_takeaways(section: Column, least: int = 15) -> Column:
    """Items that begin with a bold title; shorter ones are dropped."""
    parts = F.split(section, r"\r?\n(?=(?:-\s*|\d+\.\s*)\*\*)")
    clean = F.transform(parts, lambda p: strip_inline(F.regexp_replace(F.regexp_replace(p, r"^\d+\.\s*", ""), r"^-\s*", "")))
    return F.filter(clean, lambda p: F.length(p) > least)


def parse_protocols(section: Column, least: int = 20) -> Column:
    """``### title`` blocks with their labelled lines, as one sentence each."""
    blocks = F.filter(F.split(section, r"\r?\n(?=###\s)"), lambda b: trimmed(b).rlike(rf"^###{BLANK}"))

    def sentence(b: Column) -> Column:
        head = rf"^###{BLANK}*({NOT_LINE_END}+)"
        title = F.when(b.rlike(head), trimmed(F.regexp_extract(b, head, 1))).otherwise("Protocolo")
        said = [F.concat(F.lit(f" {name}: "), F.regexp_extract(b, rf"(?iu)\*\*{label}:\*\*{BLANK}*({NOT_LINE_END}+)", 1)) for name, label in PROTOCOL_LABELS]
        return strip_inline(F.concat(title, F.lit("."), *said))

    return F.filter(F.transform(blocks, sentence), lambda p: F.length(p) > least)


def leading_int(c: Column) -> Column:
    """The number that a text begins with, else null."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int")


def padded(c: Column, width: int = 3) -> Column:
    """Zeros in front up to the width; longer texts stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def episode_key(number: Column, folder: Column) -> Column:
    """The number of the front matter, else of the folder, with at least three digits."""
    return padded(filled(number, F.regexp_replace(folder, "EP-", "")))


def row_id(key: Column, suffix: Column | str) -> Column:
    return F.concat(F.lit("hub-ep"), key, F.lit("-"), F.lit(suffix) if isinstance(suffix, str) else suffix)


def episode_of(c: Column) -> Column:
    """Episode number out of a row id, else null."""
    return F.regexp_extract(c, r"hub-ep(\d+)-", 1).try_cast("int")


def once(c: Column, f) -> Column:
    """f of a column that is evaluated once, however often f names it."""
    return F.transform(F.array(c), f)[0]


def titled(key: Column, title: Column, before: str, after: str) -> Column:
    return F.concat(F.lit(before), key.cast("int").cast("string"), title, F.lit(after))


def overview_row(key: Column, title: Column, guest: Column, section: Column, limit: int = 1200, least: int = 40) -> Column:
    """Overview text, or null where the section is too short."""
    named = F.concat(F.when(title != "", F.concat(F.lit(" - "), title)).otherwise(""), F.when(guest != "", F.concat(F.lit(" (invitado: "), guest, F.lit(")"))).otherwise(""))
    return once(F.substring(strip_inline(section, True), 1, limit), lambda body: F.when(F.length(body) > least, F.concat(titled(key, named, "Episodio ", ". "), body)))


def resources_row(key: Column, title: Column, section: Column, limit: int = 1500, least: int = 40) -> Column:
    """Resources text, or null where the section is too short."""
    named = F.when(title != "", F.concat(F.lit(" ("), title, F.lit(")"))).otherwise("")
    row = lambda body: F.when(F.length(body) > least, F.concat(titled(key, named, "Recursos y estudios mencionados en el episodio ", ": "), body))
    return once(F.substring(strip_inline(section, True), 1, limit), row)


def ts_seconds(c: Column) -> Column:
    """h:m:s or m:s to seconds; a number as it is; another single part is 0; a bad part among several gives null."""
    parts = F.split(c, ":")
    at = lambda i: F.trim(F.element_at(parts, i)).try_cast("int")
    return (
        F.when(F.size(parts) == 3, at(1) * 3600 + at(2) * 60 + at(3))
        .when(F.size(parts) == 2, at(1) * 60 + at(2))
        .otherwise(F.coalesce(F.trim(c).try_cast("int"), F.lit(0)))
    )


def chunk_id(key: Column, ts: Column, part: Column, parts: Column) -> Column:
    return F.concat(row_id(key, F.concat(F.lit("ts"), F.regexp_replace(ts, ":", ""))), F.when(parts > 1, F.concat(F.lit("-p"), part.cast("string"))).otherwise(""))


def video_id(c: Column) -> Column:
    """A struct of a valid 11-character id, or null and the reason."""
    found = F.regexp_replace(F.trim(c), "^['\"]|['\"]$", "")
    valid = F.coalesce(found.rlike("^[A-Za-z0-9_-]{11}$"), F.lit(False))
    return F.struct(F.when(valid, found).alias("id"), F.when(F.coalesce(found, F.lit("")) == "", "missing").when(~valid, "invalid").alias("reason"))


def md_title(c: Column, fallback: Column | str) -> Column:
    """The first ``# `` line; of ``EP-x - T`` the T."""
    line = F.regexp_extract(c, r"(?m)^# [^\S\n]*(\S[^\n]*)$", 1)
    return filled(F.trim(F.regexp_replace(line, r"^EP-\S+\s+-\s+", "")), fallback)


def md_counts(c: Column) -> Column:
    """Counts of ``## `` headers, ``---`` fences and ``title:`` lines."""
    count = lambda p: F.regexp_count(c, F.lit(p)).cast("int")
    return F.struct(count(r"(?m)^## ").alias("headers"), count(r"(?m)^---$").alias("fences"), count(r"(?m)^title:").alias("titles"))


def normalize_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\r\n"), F.lit("\n"))


HEADING_MARK = "## "
_LOST_HEADER = r"(?m)^(\[\d{2}:\d{2}:\d{2}\][^\S\n]+\S.*)$"


def lost_headings(c: Column) -> Column:
    """Number of ``[hh:mm:ss] title`` lines without a mark."""
    return F.regexp_count(c, F.lit(_LOST_HEADER)).cast("int")


def restore_headings(c: Column) -> Column:
    """Puts the mark back before ``[hh:mm:ss] title`` lines; text and number of lines."""
    return F.struct(F.regexp_replace(c, _LOST_HEADER, f"{HEADING_MARK}$1").alias("text"), lost_headings(c).alias("fixed"))


def normalized(c: Column) -> Column:
    """Lower-case with runs of blanks as one space: equal for texts that read alike."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def is_smalltalk(c: Column) -> Column:
    """Nothing but a greeting or thanks."""
    return F.coalesce(F.translate(F.lower(F.trim(c)), "áéíóú¡!¿?.,", "aeiou").rlike("^(?:" + "|".join(SMALL_TALK) + ")$"), F.lit(False))


def rrf(rank: Column, k: int = 50) -> Column:
    """1 / (k + rank); nothing for a missing rank."""
    return F.coalesce(F.lit(1.0) / (F.lit(k) + rank), F.lit(0.0))


def parse_transcript_meta(c: Column) -> Column:
    """Front matter of a transcript (``key: value`` lines, LF only) and the body after it; the last key wins.

    Only a whole line of three dashes closes the block; without one all is body."""
    block = r"^---\n([\s\S]*?)\n---\n"
    lines = F.filter(F.split(F.regexp_extract(c, block, 1), "\n"), lambda x: x.rlike(rf"^\w+:{BLANK}*{NOT_LINE_END}*\z"))
    value = lambda x: F.regexp_replace(F.regexp_replace(x, rf"^\w+:{BLANK}*", ""), r'^"|"\z', "")
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^(\w+):", 1).alias("key"), value(x).alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]))
    return F.struct(last.alias("meta"), F.regexp_replace(c, block, "").alias("body"))


FRONT_MATTER = T.StructType().add("meta", T.MapType(T.StringType(), T.StringType())).add("temas", T.ArrayType(T.StringType())).add("etiquetas", T.ArrayType(T.StringType()))


def front_matter(text: str | None) -> dict:
    """Scalars by key and the two lists of one summary. An inline ``temas: x`` is a text: its characters are the list."""
    lists: dict[str, list[str] | str] = {"temas": [], "etiquetas": []}
    meta: dict[str, str] = {}
    found = re.match(r"---\r?\n(.*?)\r?\n---", text or "", re.S)
    open_list = None
    for line in re.split(r"\r?\n", found[1]) if found else ():
        if head := re.match(r"(temas|etiquetas):\s*$", line):
            open_list = head[1]
        elif open_list and (item := re.match(r"-\s*(.+)$", line)):
            if isinstance(lists[open_list], list):
                lists[open_list].append(item[1].strip())
        elif pair := re.match(r"([a-zA-Záéíóúñ_]+):\s*(.*)$", line):
            open_list = None
            value = re.sub(r"""^(['"])(.*)\1$""", r"\2", pair[2]).strip()
            if pair[1] in lists:
                lists[pair[1]] = value
            else:
                meta[pair[1]] = value
    return {"meta": meta, **{k: list(v) for k, v in lists.items()}}


@F.pandas_udf(FRONT_MATTER)
def parse_frontmatter(texts: pd.Series) -> pd.DataFrame:
    """Front matter of a summary: its lines depend on those before, so this is a helper."""
    rows = [front_matter(t) for t in texts]
    return pd.DataFrame({"meta": [r["meta"] for r in rows], "temas": [r["temas"] for r in rows], "etiquetas": [r["etiquetas"] for r in rows]})
