"""Full-text search: token table, web-search queries, cover-density rank.

Terms are AND-ed: a document matches a query when it has all terms (or phrases) of one of its ``or`` groups
and none that the query excludes. The rank adds up minimal covers: spans of positions that hold all terms and
no smaller such span; each counts 0.1 / (1 + positions in it that are not needed).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorebank.functions.spanish import stem, stop_words

WEIGHT = 0.1
_WORD = r"[\p{L}\p{N}_]+"


def stemmed(words: Column, stop: frozenset[str] = frozenset()) -> Column:
    """Spanish stems of an array of words in lower case; null for stop words and nulls."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def stems(column: pa.Array) -> pa.Array:
        coded = column.flatten().dictionary_encode()  # each distinct word of a batch is stemmed once
        own = pa.array([None if w is None or w in stop else stem(w) for w in coded.dictionary.to_pylist()], pa.string())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.ListArray.from_arrays(offsets, own.take(coded.indices), mask=column.is_null())

    return stems(words)


def tokenize(c: Column, config: str = "plain") -> Column:
    """Terms with positions from 1; stop words of ``spanish`` are left out but count as positions."""
    words = F.regexp_extract_all(F.lower(c), F.lit(_WORD), F.lit(0))
    terms = words if config == "plain" else stemmed(words, stop_words())
    rows = F.transform(terms, lambda t, i: F.struct(t.alias("term"), (i + 1).alias("pos")))
    return rows if config == "plain" else F.filter(rows, lambda r: r["term"].isNotNull())


def token_rows(docs: DataFrame, config: str = "plain", id_col: str = "id", text_col: str = "content") -> DataFrame:
    """id, term, pos: one row a token, without a shuffle."""
    return docs.select(F.col(id_col).alias("id"), F.explode(tokenize(F.col(text_col), config)).alias("t")).select("id", "t.term", "t.pos")


def gathered(tokens: DataFrame) -> DataFrame:
    """Tokens to id, term, positions."""
    return tokens.groupBy("id", "term").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def term_table(docs: DataFrame, config: str = "plain", id_col: str = "id", text_col: str = "content") -> DataFrame:
    """id, term, positions, to be written bucketed or sorted by term. For one search, ``token_rows`` will do."""
    return gathered(token_rows(docs, config, id_col, text_col))


def parsed_query(text: str | None, config: str = "plain", stop: frozenset[str] | None = None) -> dict:
    """Groups (joined by or) of phrases (all needed), and excluded phrases, of a web-search query.

    ``stop``: stop words of ``spanish``; on the driver Spark's list by default."""
    if config != "plain" and stop is None:
        stop = stop_words()
    clean = (lambda w: w) if config == "plain" else (lambda w: None if w in stop else stem(w))
    groups, out = [[]], []
    for dash, quoted, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', (text or "").lower()):
        if not quoted and word == "or" and not dash:
            groups.append([])
            continue
        phrase = [t for w in re.findall(r"\w+", quoted or word) if (t := clean(w))]
        if phrase:
            (out if dash else groups[-1]).append(phrase)
    return {"groups": [g for g in groups if g], "excluded": out}


_PHRASES = T.ArrayType(T.ArrayType(T.StringType()))
QUERY = T.StructType().add("groups", T.ArrayType(_PHRASES)).add("excluded", _PHRASES)


def parse_query(c: Column, config: str = "plain") -> Column:
    stop = frozenset() if config == "plain" else stop_words()

    @F.pandas_udf(QUERY)
    def parsed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parsed_query(t, config, stop) for t in texts], columns=["groups", "excluded"])

    return parsed(c)


def _phrase_starts(phrase: list[str], held: dict[str, np.ndarray]) -> np.ndarray:
    at = held.get(phrase[0], np.zeros(0, int))
    for i, term in enumerate(phrase[1:], 1):
        at = at[np.isin(at + i, held.get(term, np.zeros(0, int)))]
    return at


def cover_density(spots: list[tuple[np.ndarray, int]], weight: float = WEIGHT) -> float:
    """spots: positions and width of each phrase."""
    events = sorted((int(p), k) for k, (at, _) in enumerate(spots) for p in at)
    need = sum(width for _, width in spots)
    last: dict[int, int] = {}
    covers: list[tuple[int, int]] = []
    for p, k in events:
        last[k] = p
        if len(last) == len(spots):
            first = min(last.values())
            end = max(q + spots[j][1] - 1 for j, q in last.items())
            if covers and covers[-1][0] == first:
                continue  # the earlier cover from the same start is the smaller one
            covers.append((first, end))
    return sum(weight / (1 + max(0, end - first + 1 - need)) for first, end in covers)


def _rank(groups, excluded, terms, positions) -> float | None:
    held = dict(zip(terms, map(np.asarray, positions)))
    if any(len(_phrase_starts(list(p), held)) for p in excluded):
        return None
    best = None
    for group in groups:
        spots = [(_phrase_starts(list(p), held), len(p)) for p in group]
        if all(len(at) for at, _ in spots):
            best = max(best or 0.0, cover_density(spots))
    return best


@F.pandas_udf(T.DoubleType())
def text_rank(groups: pd.Series, excluded: pd.Series, terms: pd.Series, positions: pd.Series) -> pd.Series:
    """Cover-density rank of a document's terms and their positions; null where it does not match."""
    return pd.Series([_rank(*x) for x in zip(groups, excluded, terms, positions)], dtype="float64")


def text_candidates(queries: DataFrame, doc_terms: DataFrame, config: str = "plain") -> DataFrame:
    """Documents with all terms of a group of a query: query_text, id, text_rank.

    queries: query_text; equal ones are ranked once. doc_terms: a term table, or the rows of tokens. Terms of
    queries are broadcast if they are few (measured once, with all that the joins take of them): tokens are dropped where they are read unless a query
    has them, and only those are gathered. A query of one word is ranked by its count alone."""
    from lorebank.operators.kb import is_small

    parsed = queries.select("query_text").distinct().select("query_text", parse_query(F.col("query_text"), config).alias("q")).filter(F.size("q.groups") > 0)
    needed = F.transform("q.groups", lambda g: F.size(F.array_distinct(F.flatten(g))))
    terms = F.array_distinct(F.concat(F.flatten(F.flatten("q.groups")), F.flatten("q.excluded")))
    parsed = parsed.select("query_text", F.col("q.groups").alias("groups"), F.col("q.excluded").alias("excluded"), terms.alias("terms"), F.array_min(needed).alias("least"))
    few = is_small(parsed.select("query_text", "groups", "excluded", F.explode("terms").alias("term")))
    side = F.broadcast if few else lambda df: df
    wanted = parsed.select(F.explode("terms").alias("term")).distinct()
    held = doc_terms.join(side(wanted), "term", "left_semi")
    held = held if "positions" in held.columns else gathered(held)
    single = (F.size("terms") == 1) & (F.size("excluded") == 0) & F.forall(F.flatten("groups"), lambda phrase: F.size(phrase) == 1)
    one = held.join(side(parsed.filter(single).select("query_text", F.col("terms")[0].alias("term"))), "term")
    more = parsed.filter(~single)
    met = held.join(side(more.select("query_text", F.explode("terms").alias("term"))), "term")
    hits = met.groupBy("query_text", "id").agg(F.collect_list("term").alias("terms"), F.collect_list("positions").alias("positions"))
    enough = hits.join(side(more.select("query_text", "groups", "excluded", "least")), "query_text").filter(F.size("terms") >= F.col("least"))
    ranked = enough.select("query_text", "id", text_rank("groups", "excluded", "terms", "positions").alias("text_rank")).filter("text_rank is not null")
    return one.select("query_text", "id", (F.size("positions") * F.lit(WEIGHT)).alias("text_rank")).unionByName(ranked)


def text_topk(queries: DataFrame, doc_terms: DataFrame, k: int = 50, config: str = "plain", rows: DataFrame | None = None) -> DataFrame:
    """query_id, id, text_rank, rank: the k best of each query; ties by id. An empty query has none.

    ``rows``: ids that may be found. With a column ``scope`` in it and in the queries, a query finds only rows
    of its own scope. Matches meet these rows, not all tokens."""
    found = text_candidates(queries, doc_terms, config)
    by = ["query_text"]
    if rows is not None:
        found = found.join(rows, "id")
        by += ["scope"] if "scope" in rows.columns else []
    order = Window.partitionBy(*by).orderBy(F.desc("text_rank"), "id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return queries.select("query_id", *by).join(best, by).select("query_id", "id", "text_rank", "rank")
