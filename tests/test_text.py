import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lorebank.functions import packing as p
from lorebank.functions import spanish
from lorebank.functions import text as t
from lorebank.operators import lexical, quality

from . import plain_packing


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize("value,want", [("Sueño y Descanso", "sueno-y-descanso"), ("[", "general"), ("", "general"), (None, "general"), ("A" * 50, "a" * 40), ("--Ñandú!! ", "nandu")])
def test_slugify(spark, value, want):
    assert one(spark, t.slugify(F.col("v").cast("string")), v=value) == want


@pytest.mark.parametrize("value,want", [("01:02:03", 3723), ("12:34", 754), ("7", 7), ("x", 0), ("1:x:3", None), ("", 0)])
def test_seconds(spark, value, want):
    assert one(spark, t.ts_seconds(F.col("v")), v=value) == want


def test_strip_inline_keeps_a_lone_newline(spark):
    assert one(spark, t.strip_inline(F.col("v")), v=" **a**\nb  c [00:01](x) [01:02:03](y) d ") == "a\nb c d"
    assert one(spark, t.strip_inline(F.col("v"), True), v="### a #b") == "a b"


def test_sections_and_items(spark):
    md = "# Episodio 7: T\n## Otra\nx\n## puntos  clave del día\npreamble of some length\n- **A** first item text\n continued\n1. **B** short\n### sub\n## Fin\n"
    section = one(spark, t.extract_section(F.col("v"), t.TAKEAWAYS_HEADER), v=md)
    assert section.startswith("preamble") and section.endswith("### sub")
    items = one(spark, t.parse_takeaways(F.col("v")), v=section)
    assert items == ["preamble of some length", "A first item text continued"]  # the last one is too short
    assert one(spark, t.extract_section(F.col("v"), "nada"), v=md) == ""
    protocol = "intro\n### Respirar\n**Que:** uno\n**CÓMO:** dos\n**Cuándo:** tres\n### \n"
    assert one(spark, t.parse_protocols(F.col("v")), v=protocol)[0] == "Respirar. Que: uno Como: dos Cuando: tres"


def test_keys_and_ids(spark):
    assert one(spark, t.padded(F.col("v")), v="7") == "007" and one(spark, t.padded(F.col("v")), v="1234") == "1234"
    assert one(spark, t.leading_int(F.col("v")), v="12abc") == 12 and one(spark, t.leading_int(F.col("v")), v="abc") is None
    assert one(spark, t.episode_of(F.col("v")), v="hub-ep012-tk3") == 12
    assert one(spark, t.chunk_id(F.lit("007"), F.lit("00:01:02"), F.lit(2), F.lit(3))) == "hub-ep007-ts000102-p2"


def test_front_matter():
    text = "---\r\ntitle: 'quoted'\r\ntemas:\r\n- uno\r\n- dos\r\netiquetas:\r\n- x\r\nnúmero_episodio: \"5\"\r\n---\r\nbody"
    got = t.front_matter(text)
    assert got == {"meta": {"title": "quoted", "número_episodio": "5"}, "temas": ["uno", "dos"], "etiquetas": ["x"]}
    assert t.front_matter("---\ntemas: salud\n---\n")["temas"][0] == "s"
    assert t.front_matter("no block") == {"meta": {}, "temas": [], "etiquetas": []} == t.front_matter(None)


def test_transcript_meta(spark):
    got = one(spark, t.parse_transcript_meta(F.col("v")), v='---\ntitle: "A"\ntitle: B\nbad line\nyoutube_id: "x"\n---\nbody\n')
    assert got.meta == {"title": "B", "youtube_id": "x"} and got.body == "body\n"
    assert one(spark, t.parse_transcript_meta(F.col("v")), v="all body").body == "all body"


def test_video_id(spark):
    assert one(spark, t.video_id(F.col("v")), v='"H-XfCl-HpRM"').id == "H-XfCl-HpRM"
    assert one(spark, t.video_id(F.col("v")), v="0123456789") == (None, "invalid")
    assert one(spark, t.video_id(F.col("v").cast("string")), v=None) == (None, "missing")


def test_titles_counts_headings(spark):
    assert one(spark, t.md_title(F.col("v"), "f"), v="x\n# EP-1 - Name\n# other") == "Name"
    assert one(spark, t.md_title(F.col("v"), "f"), v="## no") == "f"
    assert one(spark, t.md_counts(F.col("v")), v="---\ntitle: a\n---\n## b\n### c\n ## d") == (1, 2, 1)
    assert one(spark, t.restore_headings(F.col("v")), v="[02:05:48] X\n[02:05:48]\n## [00:00:01] Y") == ("## [02:05:48] X\n[02:05:48]\n## [00:00:01] Y", 1)
    assert one(spark, t.is_smalltalk(F.col("v")), v="¡Hola!") and not one(spark, t.is_smalltalk(F.col("v")), v="hola, ¿qué es esto?")


def pieces(spark, texts, make):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, v string").repartition(4)
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_packing_cases(spark):
    pack = lambda text, limit: pieces(spark, [text], lambda c: p.pack_lines(c, limit))[0]
    assert pack("aaaa\nbbbb\n" + "c" * 20, 10) == ["aaaa\nbbbb", "c" * 20]
    assert pack("\n\na\n\nb", 3) == ["a\n", "b"] and pack("", 3) == [] and pack("\n\n", 3) == [] and pack(None, 3) is None
    dose = "Toma 3.5 mg al dia. Luego descansa. cola"
    assert pieces(spark, [dose], p.sentences)[0] == ["5 mg al dia. ", "Luego descansa. "]
    assert pieces(spark, ["a. . b."], p.sentences)[0] == ["a. ", " b."]
    assert "".join(pieces(spark, [dose], lambda c: p.sentences(c, True))[0]) == dose
    long = "a" * 9 + ". " + "b" * 9 + ". " + "c" * 9 + "."
    assert pieces(spark, ["x" * 4000, None, "", " " * 4000], p.split_long) == [["x" * 4000], None, [""], []]
    assert [len(x) for x in pieces(spark, [long], lambda c: p.split_long(c, 22))[0]] == [21, 10]
    assert pieces(spark, ["a b", "aa\nbb\ncc\ndd", None, "", "x"], p.bisect) == [["a", " b"], ["aa\nbb", "cc\ndd"], None, ["", ""], ["", "x"]]


def test_long_texts_without_ends_are_fast(spark):
    texts = ["palabra " * 200_000, "a.b" * 200_000]
    assert pieces(spark, texts, p.sentences) == [[], []]
    assert [len(x[0]) for x in pieces(spark, texts, p.split_long)] == [1_599_999, 600_000]
    lines = "word\n" * 100_000
    assert pieces(spark, [lines], lambda c: p.pack_lines(c, 500))[0] == plain_packing.packed_lines(lines, 500)


@pytest.mark.parametrize("limit", [5, 12, 40])
def test_packing_against_plain_loops(spark, limit):
    some = random.Random(limit)
    texts = ["".join(some.choice("ab  .!?\n\né\U0001F600") for _ in range(some.randrange(160))) for _ in range(300)]
    assert pieces(spark, texts, lambda c: p.pack_lines(c, limit)) == [plain_packing.packed_lines(x, limit) for x in texts]
    for lossless in (False, True):
        assert pieces(spark, texts, lambda c: p.sentences(c, lossless)) == [plain_packing.sentences(x, lossless) for x in texts]
        assert pieces(spark, texts, lambda c: p.split_long(c, limit, lossless)) == [plain_packing.long_parts(x, limit, lossless) for x in texts]
    assert pieces(spark, texts, p.bisect) == [plain_packing.halves(x) for x in texts]


def test_ghost_blocks():
    head = "---\ntitle: a\n---\n"
    assert p.without_ghosts(head + "x\n---\ntype: t\ntitle: b\n---\ny") == (head + "x\ny", 1)
    assert p.without_ghosts(head + "x\n---\ntitle: " + "b" * 300 + "\ny") == (head + "x\ny", 1)
    assert p.without_ghosts(head + "x\n---\ny") == (head + "x\n---\ny", 0)
    assert p.without_ghosts("x\n---\ntitle: b\n---\n") == ("x\n---\ntitle: b\n---\n", 0)


def test_unpack(spark):
    df = spark.createDataFrame([(1, 1, " b "), (1, 0, "a"), (2, 0, "c")], "d int, p int, t string")
    assert {(r.d, r.t) for r in p.unpack(df, "d", "p", "t").collect()} == {(1, "a\n\nb"), (2, "c")}


def test_a_discarded_translation_is_not_done_any_more(spark):
    progress = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "episode_id string, transcript boolean")
    audit = spark.createDataFrame([("a", "ok"), ("b", "discarded"), ("c", "discarded")], "episode_id string, status string")
    assert sorted(tuple(r) for r in quality.progress_after(progress, audit).collect()) == [("a", True), ("b", False), ("c", False), ("d", True)]


def test_titles_and_capitals(spark):
    assert one(spark, t.extract_section(F.col("v"), t.OVERVIEW_HEADER), v="## DESCRIPCIÓN GENERAL DEL EPISODIO\nuno\n## x") == "uno"
    blocks = "### \u00a0\nx\n### T\n**QUÉ:** uno dos tres cuatro\n"
    assert one(spark, t.parse_protocols(F.col("v")), v=blocks)[-1].startswith("T. Que: uno")


# Words and stems of the published sample vocabulary.
SAMPLE = (
    "cheque chequ, chequeo cheque, cheques chequ, chetumaleños chetumaleñ, cheyenne cheyenn, chía chi, chiapaneca chiapanec, chiapas chiap, chic chic, chicana chican, chicas chic, chicharrones chicharron, "
    "chicles chicl, torá tor, tórax torax, torcer torc, toreados tor, toreándolo tor, torear tor, toreara tor, torearlo tor, toreó tore, toreros torer, torio tori, tormentas torment, tornado torn, tornen torn, "
    "torneos torne, tornillos tornill, torniquete torniquet, torno torn, toronto toront, torpedearon torped, torpeza torpez, torrado torr, torrenciales torrencial, torrente torrent, torreón torreon, torres torr"
)


def test_spanish_stems(spark):
    pairs = [p.split() for p in SAMPLE.split(", ")]
    assert [spanish.stem(w) for w, _ in pairs] == [s for _, s in pairs]
    endings = {"rápidamente": "rapid", "activamente": "activ", "relativamente": "relat", "biología": "biolog", "evolución": "evolu", "paguen": "pag", "sigue": "sig", "distribuyó": "distribu", "siguiéndole": "sigu", "nacionalidad": "nacional", "oso": "oso", "": "", "u": "u"}
    assert {w: spanish.stem(w) for w in endings} == endings
    assert {"de", "los", "más", "él"} <= spanish.stop_words() and "gato" not in spanish.stop_words()
    rows = spark.createDataFrame([("Más gatos, y los GATOS",), ("",), (None,)], "t string").select(lexical.tokenize(F.col("t"), "spanish").alias("t")).collect()
    assert [None if r.t is None else [(x.term, x.pos) for x in r.t] for r in rows] == [[("gat", 2), ("gat", 5)], [], None]


def test_slugs_of_letters_beyond_the_usual(spark):
    words = ["Tiếng Việt", "Ångström", "ǎ ǖ ḧ ṩ ẟ", "Öffnung ß", "naïve — café", "İstanbul Kelvin", "日本", "ﬁn ½ ²", "é ȫ", "ά ў", None, ""]

    def plain(s):
        s = unicodedata.normalize("NFD", (s or "general").lower())
        s = re.sub("[̀-ͯ]", "", s)
        return re.sub("^-+|-+$", "", re.sub("[^a-z0-9]+", "-", s))[:40] or "general"

    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    assert {r.i: r.s for r in df.select("i", t.slugify(F.col("w")).alias("s")).collect()} == {i: plain(w) for i, w in enumerate(words)}
    assert plain(words[0]) == "tieng-viet"


def test_front_matter_closes_with_a_whole_line(spark):
    def meta(raw):
        r = spark.createDataFrame([(raw,)], "t string").select(t.parse_transcript_meta(F.col("t")).alias("m")).first().m
        return r.meta, r.body

    assert meta("---\na: 1\n---- x\nb: 2\n---\nbody") == ({"a": "1", "b": "2"}, "body")
    assert meta("---\na: 1\n---- x\nbody") == ({}, "---\na: 1\n---- x\nbody")
    assert meta("---\na: 1\n---") == ({}, "---\na: 1\n---")
    assert meta('---\ntitle:\t"Talk"\nx: "a" \n---\n') == ({"title": "Talk", "x": 'a" '}, "")
    assert meta("---\na: 1\rz\nb: \nc: ok\u0085\n---\nbody") == ({"b": "", "c": "ok\u0085"}, "body")


def test_protocol_lines_end_where_the_format_says(spark):
    section = "### Sleep\u0085well\n**Qué:** dark\u0085room\n**Cómo:**\tblinds no\n###   Walk \t\n**Cuándo:** now"
    (r,) = spark.createDataFrame([(section,)], "t string").select(t.parse_protocols(F.col("t")).alias("p")).collect()
    assert r.p == ["Sleep\u0085well. Que: dark\u0085room Como: blinds Cuando:", "Walk. Que: Como: Cuando: now"]


def test_sections_with_the_marks_own_characters(spark):
    from lorebank.operators.chunking import split_sections

    body = "## [00:01] A\none \u0001 x \u0001\u0003\n## 00:02\tB\t\ntwo\u0001\u0002\n## [00:03]\n## [00:04] D\nthree\u0085## [00:05] not\n##[1:00:06] E"
    got = spark.createDataFrame([(body,)], "t string").select(split_sections(F.col("t")).alias("s")).first().s
    assert [(s.pos, s.ts, s.ts_end, s.title) for s in got] == [(1, "00:01", "00:02", "A"), (2, "00:02", "00:03", "B"), (3, "00:03", "1:00:06", "## [00:04] D"), (4, "1:00:06", None, "E")]
    assert [s.text for s in got] == ["one \u0001 x \u0001\u0003", "two\u0001\u0002", "three ## [00:05] not", ""]


def test_a_lone_sentence_of_a_long_text(spark):
    """As the queries' SQL has it: the only sentence of a text stays as it was found. Elsewhere it is trimmed."""
    tail = "x " * 1600
    texts = [" One. " + tail, "One. Two. " + tail, " " + "y" * 3000 + ". " + tail, "a.b. " + tail, "\nOne!\n", "One. " + "z" * 2995 + ".", None]
    got = pieces(spark, texts, lambda c: p.split_long(c, trim_lone=False))
    assert got == [[" One. "], ["One. Two."], ["y" * 3000 + "."], ["b. "], ["\nOne!\n"], ["One.", "z" * 2995 + "."], None]
    assert pieces(spark, texts, p.split_long)[:4] == [["One."], ["One. Two."], ["y" * 3000 + "."], ["b."]]


def test_parts_against_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from lorebank.jobs import queries

    tail = "x " * 1600
    texts = ["Uno. " + tail, " Uno! " + tail, "Uno. Dos. " + tail, "a.b. " + tail, "", "Uno. ", " ", tail, "Uno. " * 900, "y" * 4000 + ". ", None, "Uno. " + tail]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name, cols in (("split_parts", ["doc_id", "pos", "chars", "part_md5"]), ("split_sentences", ["doc_id", "parts", "longest"])):
        got = sorted(tuple(r) for r in queries.QUERIES[name](spark, str(tmp_path)).select(*cols).collect())
        assert got == sorted(con.execute(f"select {', '.join(cols)} from ({queries.ORACLE_SQL[name]})").fetchall())
