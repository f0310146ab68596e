"""Stems of Spanish words by the published Snowball rules, and Spark's own list of Spanish stop words.

A word has three regions, each given by where it starts: RV (verb endings), R1 and R2 (endings of nouns,
adjectives and adverbs). An ending is taken off where it begins in its region or after. Alternatives of a
pattern that ends with ``$`` are met from the left, so the longest ending is found first."""

from __future__ import annotations

import re
from functools import lru_cache

# The vowels and endings of the published Spanish stemmer.
_VOWEL, _OTHER = "[aeiouáéíóúü]", "[^aeiouáéíóúü]"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
BEFORE_PRONOUNS = "iéndo ándo ár ér ír ando iendo ar er ir uyendo"
PLAIN = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
AFTER_IC = "adora ador ación acion adoras adores aciones ante antes ancia ancias"
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
GU_VERBS = "en es éis emos"
VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré "
    "aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais "
    "ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
)
REST = "os a o á í ó e é"
_ACUTE = str.maketrans("áéíóú", "aeiou")


def _ending(words: str) -> re.Pattern:
    return re.compile("(?:" + words.replace(" ", "|") + ")$")


_PRONOUN, _BEFORE = _ending(PRONOUNS), _ending(BEFORE_PRONOUNS)
_Y, _VERB, _RESIDUE = _ending(Y_VERBS), _ending(f"{GU_VERBS} {VERBS}"), _ending(REST)

#: Endings of nouns, adjectives and adverbs: pattern of the ending, what takes its place, and endings before it
#: that then go too (in R2). ``amente`` needs R1, the others R2.
_STANDARD = {
    **dict.fromkeys(PLAIN.split(), ("", None)), **dict.fromkeys(AFTER_IC.split(), ("", _ending("ic"))), **dict.fromkeys(("logía", "logías"), ("log", None)),
    **dict.fromkeys(("ución", "ucion", "uciones"), ("u", None)), **dict.fromkeys(("encia", "encias"), ("ente", None)), "amente": ("", _ending("ativ iv os ic ad")),
    "mente": ("", _ending("ante able ible")), **dict.fromkeys(("idad", "idades"), ("", _ending("abil ic iv"))), **dict.fromkeys(("iva", "ivo", "ivas", "ivos"), ("", _ending("at"))),
}
_NOUN = _ending(" ".join(_STANDARD))
_AFTER_VOWEL = re.compile(f"{_VOWEL}{_OTHER}")
_RV = re.compile(f"{_VOWEL}{_VOWEL}+{_OTHER}|.{_OTHER}+{_VOWEL}|{_OTHER}{_VOWEL}.")


def _after(pattern: re.Pattern, word: str, start: int = 0) -> int:
    m = pattern.search(word, start)
    return m.end() if m else len(word)


def _standard(word: str, r1: int, r2: int) -> str | None:
    m = _NOUN.search(word)
    if not m or m.start() < (r1 if m[0] == "amente" else r2):
        return None
    into, before = _STANDARD[m[0]]
    word = word[: m.start()]
    m = before.search(word) if before else None
    if m and m[0] == "ativ" and m.start() < r2:
        m = re.search("iv$", word)  # the longer one begins before R2
    return (word[: m.start()] if m and m.start() >= r2 else word) + into


def _verb(word: str, rv: int) -> str:
    m = _Y.search(word, rv)
    if m and word[: m.start()].endswith("u"):
        return word[: m.start()]
    m = _VERB.search(word, rv)
    if not m:
        return word
    word, gu = word[: m.start()], m[0] in GU_VERBS.split()
    return word[:-1] if gu and word.endswith("gu") else word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a word in lower case."""
    m = _RV.match(word)
    rv, r1 = m.end() if m else len(word), _after(_AFTER_VOWEL, word)
    r2 = _after(_AFTER_VOWEL, word, r1)
    if m := _PRONOUN.search(word):
        verb = word[: m.start()]
        m = _BEFORE.search(verb)
        if m and m.start() + (m[0] == "uyendo") >= rv:
            word = verb[: m.start()] + m[0].translate(_ACUTE)
    short = _standard(word, r1, r2)
    word = _verb(word, rv) if short is None else short
    if m := _RESIDUE.search(word, rv):
        word = word[: m.start()]
        if m[0] in "eé" and word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word.translate(_ACUTE)


@lru_cache(maxsize=1)
def stop_words() -> frozenset[str]:
    """Spark's list of Spanish stop words; read on the driver, where a session must run, and handed to tasks."""
    from pyspark.ml.feature import StopWordsRemover

    return frozenset(StopWordsRemover.loadDefaultStopWords("spanish"))
