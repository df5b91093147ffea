"""Spelling variant grouping: pairs of words one edit apart by asymmetric q-chunks.

Of two words the shorter one (of equal lengths either) contributes two disjoint chunks, its halves; the
other contributes its positional grams of that length. One edit leaves one chunk as it is, at its place
or shifted by one, so equal (length, place, text) keys within a shift of one find every pair. Grams whose
place is further from every chunk's can meet none and are not made.

A key that many words share is not joined: the half in which its edit lies is chunked in two again, and the
chunk that is preserved joins the key. This goes on for the keys that are still shared by more than ``LIMIT``
words, until the part with the edit is one character, where the words that share a key are links of each
other. So no group is expanded into pairs that are not nearly all links, and none is lost. Candidates are
verified with ``levenshtein``. Everything runs in DataFrame functions.

Defined cases: null and empty texts have no words; a null id counts as an empty one where ids decide on
deleted characters; repeated rows count as often as they occur; no words give an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import common

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT = 5, 3
#: One run in so many (by hash of id and run) loses a character.
DELETE_ONE_IN = 97
#: Candidates of a key (chunks times all its members) beyond which its words are told apart further.
LIMIT = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word): every run of letters, lower-cased; every ``one_in``-th by hash without one of its characters."""
    cells = common.texts(docs, id_col, text_col).select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("head"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    hashed = cells.select("run", F.crc32(F.concat("head", "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, *, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of so many letters that occur so often."""
    return words.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _edge(k: Column, level: int) -> Column:
    """Where part ``k`` begins when ``base`` characters are cut into 2^level parts."""
    return F.shiftright(k * F.col("base"), level)


def _keyed(rows: DataFrame, level: int) -> DataFrame:
    """With the key of each row: what is left of its word without part ``k`` (one character longer in the longer word)."""
    head = F.substr("word", F.lit(1), _edge(F.col("k"), level))
    tail = F.substr("word", _edge(F.col("k") + 1, level) + F.col("longer") + 1)
    return rows.withColumn("key", F.xxhash64("base", F.lit(level), "k", head, F.lit("|"), tail))


def pairs(words: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """(a, a_n, b, b_n): each pair of different words (distinct rows of word, n) within one edit once."""
    size = F.char_length("word")
    roles = F.explode(F.array(*[F.struct(F.lit(longer).alias("longer"), F.lit(k).alias("k")) for longer in (0, 1) for k in (0, 1)])).alias("r")
    rows = words.select("word", "n", size.alias("size"), roles).select(
        "word", "n", (F.col("size") - F.col("r.longer")).alias("base"), "r.longer", "r.k").filter("base > 0")
    found, level = [], 1
    while True:
        keyed = _keyed(rows, level)
        chunks = F.sum(1 - F.col("longer"))
        part = _edge(F.col("k") + 1, level) - _edge(F.col("k"), level)
        hot = (F.col("chunks") * F.col("members") > limit) & (F.col("part") > 1)
        met = keyed.groupBy("key").agg(chunks.alias("chunks"), F.count("*").alias("members"), F.max(part).alias("part"))
        met = met.filter("chunks > 0 AND members > 1").select("key", hot.alias("hot"))
        # stored, so that the join with it deals out both sides and can split a key that many words share
        met = common.stored(met, "spelling-keys")
        marked = common.stored(keyed.join(met, "key"), "spelling-members")
        cold = marked.filter("NOT hot")
        chunk = cold.filter("longer = 0").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        other = cold.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("b_n"))
        met_pairs = chunk.join(other, "key").filter("longer = 1 OR a < b").filter(F.levenshtein("a", "b", 1) == 1)
        found.append(common.stored(met_pairs.select("a", "a_n", "b", "b_n"), "spelling-pairs"))
        hot_rows = marked.filter("hot")
        if hot_rows.isEmpty():
            break
        level += 1
        halves = F.explode(F.array(2 * F.col("k"), 2 * F.col("k") + 1)).alias("k")
        rows = hot_rows.select("word", "n", "base", "longer", halves).filter(_edge(F.col("k") + 1, level) > _edge(F.col("k"), level))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def forms(words: DataFrame, links: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's form is its near word of largest n if that is at least twice its own."""
    turned = links.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    best = links.unionByName(turned).groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    joined = words.join(best, words["word"] == best["a"], "left")
    form_n = -F.col("best.less")
    strong = form_n >= 2 * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(strong, F.col("best.form")).alias("form"), F.when(strong, form_n).cast("long").alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) for each word that has a form. Counts at least double at each step, which bounds the chains; steps are doubled too."""
    chain = common.stored(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    most = formed.agg(F.max("form_n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(2.0, math.log2(most) + 1)))):
        onward = chain.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        chain = common.stored(chain.join(onward, F.col("root") == F.col("_from"), "left").select("word", F.coalesce("_to", "root").alias("root")), "spelling-roots")
    return chain


def group(words: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct words and their counts."""
    words = common.stored(words.select("word", "n"), "spelling-words")
    formed = common.stored(forms(words, pairs(words, limit=limit)), "spelling-forms")
    found = roots(formed).withColumnRenamed("word", "_word")
    return formed.join(found, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(vocabulary(runs(common.table(spark, sf_dir, "documents"))))


#: Pairs come from equal strings with one character left out; crc32 is worked out bit by bit.
SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)) AS t),
cells AS (
  SELECT doc_id, translate(w, '{_UPPER}', '{_LOWER}') AS run, count(*) AS m
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY ALL),
coded AS (
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END)) AS bytes FROM cells),
hashed AS (
  SELECT run, m, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, bytes::UBIGINT[]), lambda c, b: xor(c // 256, t[xor(c % 256, b)::INT + 1]))) AS h FROM coded, crc),
words AS (
  SELECT word, sum(m)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {DELETE_ONE_IN} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, m FROM hashed)
  WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(m) >= {MIN_COUNT}),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n FROM cuts a JOIN cuts b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.v = b.word),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS top, min(b) FILTER (WHERE n = best_n) AS form
  FROM (SELECT *, max(n) OVER (PARTITION BY a) AS best_n FROM near) GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 2 * w.n THEN form END AS form, CASE WHEN top >= 2 * w.n THEN top END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at, form AS onward FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON f.word = w.onward)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk k ON k.word = f.word AND k.onward IS NULL
"""
