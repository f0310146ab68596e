"""Small documents with the cases that every operator must stand: nulls, empty and long texts, ties, repeated rows."""

import random
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Columns with names that operators use inside.
CLASHING = ["h", "size", "shard", "kept", "score", "key", "class_id", "registers", "text_sha256", "bucket", "label", "n_words", "log_weight"]


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(rng, n):
    syllables = ["th", "er", "on", "an", "re", "ing", "ed", "nd", "ou", "tion", "é", "ß", "ñ", "the", "of"]
    out = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in out)


def rows(seed=1, n=60):
    rng = random.Random(seed)
    out = [(i, prose(rng, rng.randint(1, 120)), "en", f"src{i % 5}", 0) for i in range(n)]
    out += [(n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, "   \n\t ", "en", "src0", 5), (n + 3, prose(rng, 30_000), "en", "src0", 1)]
    out += [(n + 4, out[3][1], "en", "src1", 0), (n + 5, out[3][1].upper(), "en", "src1", 0), (n + 6, "", None, "src0", 0)]
    out += [out[7], out[7]]  # repeated rows
    return out


def frame(spark, data, schema=SCHEMA, parts=5):
    return spark.createDataFrame(data, schema).repartition(parts)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(1) for c in CLASHING})
