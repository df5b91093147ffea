"""Line dedup within one edit by a deletion-neighbourhood join, in DataFrame functions only.

A document's lines are its text split at line feeds; a line counts without blanks at its ends. All lines of
at least ``exact_chars`` characters (every one that is not blank) lose exact repeats, those of at least
``min_chars`` also lines within one edit: in shorter ones an edit makes another word. In the order of (doc_id, position) a line is removed if an equal line came before it, or if some earlier
different line of ``min_chars`` is within one edit (substitution, insertion or deletion of a character) of it.

All variants with one deleted character would be a row for each character of the corpus, so two
lossless filters come first. (1) Halves: one edit leaves the head or the tail of a line as it is, so
only lines that share a head or tail hash with another line go on. (2) Blocks: two lines that differ
by one edit agree outside one block of ``BLOCK`` characters, up to a shift behind it; block
signatures find which block. Only there the variants are emitted, as hashed keys: a variant's hash is
composed of its block hashes, so that a line costs time in proportion to its length. Variants that
are equal at the same position are a substitution, a variant equal to a whole line is an insertion or deletion. Each
key keeps its earliest line (a minimum, no pairs), the claim is verified with ``levenshtein``.

Defined cases: null text is empty and stays null; equal rows (same id, same text) are one document
and keep the same lines; rows with the same id are told apart by position and line hash; a null id
comes last; documents that lose every line keep an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common

#: Characters of lines that are compared within one edit, and of those that are compared at all.
MIN_CHARS, EXACT_CHARS = 30, 1
BLOCK = 32
#: 64-bit words of the filter that keeps most lines out of the shuffle of candidate texts (a fixed 2 MB of bits).
FILTER_WORDS = 1 << 18
#: Characters removed from both ends of a line before it is compared.
_BLANKS = " \t\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def _mix(x: Column, j: Column) -> Column:
    return F.xxhash64(x, j)


def _order(id_col: str = "doc_id", pos: str = "pos") -> Column:
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(pos).alias("pos"))


def lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc_id, pos, line, h1, h2) of the lines of at least ``min_chars``."""
    cells = common.texts(docs, id_col, text_col).select("doc_id", F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    return cells.select("doc_id", "pos", _bare(F.col("line")).alias("line")).filter(F.char_length("line") >= min_chars).select(
        "doc_id", "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), F.col("line")).alias("h2"))


def _half_keys(line: Column) -> Column:
    """Hashes of heads and tails of a fixed share of the length; a length that begins a class also counts in the class below."""
    size = F.char_length(line)
    part = F.floor(size / 4).cast("int")
    ends = lambda p: [F.xxhash64(F.lit("head"), p, F.substr(line, F.lit(1), p * 2)), F.xxhash64(F.lit("tail"), p, F.right(line, p * 2))]
    return F.when(size % 4 == 0, F.array(*ends(part), *ends(part - 1))).otherwise(F.array(*ends(part)))


def _xor(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _block_hashes(line: Column, shift: int) -> Column:
    """Hashes of the blocks from the left, read ``shift`` characters further on."""
    count = F.ceil(F.greatest(F.char_length(line) - shift, F.lit(1)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda j: _mix(F.substr(line, j * BLOCK + 1 + shift, F.lit(BLOCK)), j))


def _word() -> Column:
    return F.pmod(F.shiftright("h1", 6), F.lit(FILTER_WORDS)).cast("int")


def _bit() -> Column:
    return F.col("h1").bitwiseAND(F.lit(63)).cast("int")


def _prefiltered(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose h1 may be in ``wanted``: a Bloom filter with one hash, at most FILTER_WORDS rows, so it may be broadcast.

    It lets everything wanted through; the more there is, the more of the rest passes, which the join behind it removes.
    """
    bits = wanted.groupBy(_word().alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit())).alias("_bits"))
    hit = F.call_function("shiftright", F.col("_bits"), _bit()).bitwiseAND(F.lit(1)) == 1
    return rows.join(F.broadcast(bits), (_word() == F.col("_word")) & hit).drop("_word", "_bits")


def near(distinct: DataFrame, all_lines: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one edit.

    ``distinct`` has h1, h2, first (order of the first occurrence) and keys; ``all_lines`` has the texts.
    """
    keyed = distinct.select("h1", "h2", "first", F.explode("keys").alias("k"))
    shared = keyed.groupBy("k").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("k")
    # what is joined with its own source is stored first, here and below: the joins then deal out both sides and can split a frequent key
    shared = common.stored(shared, "line-keys")
    candidates = common.stored(keyed.join(shared, "k").groupBy("h1", "h2").agg(F.min("first").alias("first")), "line-near")
    texts = _prefiltered(all_lines, candidates).join(candidates, ["h1", "h2"]).filter(_order() == F.col("first")).groupBy("h1", "h2").agg(
        F.min("first").alias("first"), F.min("line").alias("line"))
    texts = common.stored(texts, "line-candidates")

    # block signatures: (length, block, everything outside it); a line also stands for each line it becomes by one deletion
    size = F.char_length("line")
    plain, shifted = _block_hashes(F.col("line"), 0), _block_hashes(F.col("line"), 1)
    blocks = texts.select("h1", "h2", "first", size.alias("size"), plain.alias("x"), shifted.alias("y"), "line").select(
        "*", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / BLOCK).cast("int"))).alias("j"))  # a full last block has an empty one behind it
    outside = lambda after: _xor(F.concat(F.slice("x", F.lit(1), F.col("j")), F.slice(after, F.col("j") + 2, F.greatest(F.size(after) - F.col("j") - 1, F.lit(0)))))
    block = F.substr("line", F.col("j") * BLOCK + 1, F.lit(BLOCK + 1))
    blocks = blocks.select("h1", "h2", "first", "size", "j", block.alias("block"), outside("x").alias("same"), outside("y").alias("less"))
    signed = blocks.select("h1", "h2", "j", F.explode(F.array(
        F.struct(F.col("size").alias("n"), F.col("same").alias("sig")), F.struct((F.col("size") - 1).alias("n"), F.col("less").alias("sig")))).alias("s"))
    signed = signed.select("h1", "h2", "j", F.xxhash64("s.n", "j", "s.sig").alias("s"))
    met = signed.groupBy("s").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("s")
    met = common.stored(met, "line-signatures")
    open_blocks = signed.join(met, "s").select("h1", "h2", "j").distinct()

    # deletion variants of the open blocks, and the whole lines as what a variant may equal
    at = F.explode(F.sequence(F.lit(1), F.least(F.char_length("block"), F.lit(BLOCK)))).alias("i")
    cut = F.concat(F.substr("block", F.lit(1), F.col("i") - 1), F.substr("block", F.col("i") + 1, F.lit(BLOCK + 1)))
    variants = blocks.filter("block <> ''").join(open_blocks, ["h1", "h2", "j"]).select("h1", "h2", "first", "size", "j", "block", "less", at).select(
        "h1", "h2", "first", (F.col("j") * BLOCK + F.col("i")).alias("at"),
        F.xxhash64(F.col("size") - 1, F.when(F.char_length(cut) > 0, F.col("less").bitwiseXOR(_mix(cut, F.col("j")))).otherwise(F.col("less"))).alias("v"))
    whole = texts.join(open_blocks.select("h1", "h2").distinct(), ["h1", "h2"]).select("h1", "h2", "first", F.lit(0).alias("at"), F.xxhash64(size, _xor(plain)).alias("v"))
    rows = variants.unionByName(whole)
    claim = F.struct("first", "h1", "h2")
    by_variant = rows.groupBy("v").agg(F.min(F.when(F.col("at") == 0, claim)).alias("line_first"), F.min(F.when(F.col("at") > 0, claim)).alias("variant_first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    by_place = rows.filter("at > 0").groupBy("v", "at").agg(F.min(claim).alias("place_first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    by_variant, by_place = common.stored(by_variant, "line-variants"), common.stored(by_place, "line-places")
    met_rows = rows.join(by_variant, "v").join(by_place, ["v", "at"], "left")
    earlier = F.when(F.col("at") == 0, F.col("variant_first")).otherwise(F.least("line_first", "place_first"))
    claims = met_rows.select("h1", "h2", "first", earlier.alias("e")).filter("e.first < first").groupBy("h1", "h2").agg(F.min("e").alias("e"))

    # verify each claim on the texts themselves
    ours = texts.select("h1", "h2", "line")
    other = texts.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("other"))
    checked = claims.select("h1", "h2", F.col("e.h1").alias("e1"), F.col("e.h2").alias("e2")).join(ours, ["h1", "h2"]).join(other, ["e1", "e2"])
    return checked.filter(F.levenshtein("line", "other", 1) == 1).select("h1", "h2")


def removed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS) -> DataFrame:
    """(doc_id, gone): for each id the removed lines as an array of (pos, hash)."""
    all_lines = lines(docs, id_col, text_col, min(exact_chars, min_chars))
    # lines without keys do not come near others
    keys = F.when(F.char_length("line") >= min_chars, _half_keys(F.col("line")))
    distinct = all_lines.groupBy("h1", "h2").agg(F.min(_order()).alias("first"), F.count("*").alias("n"), F.min(keys).alias("keys"))
    distinct = common.stored(distinct, "lines")
    dropped = near(distinct, all_lines).withColumn("near", F.lit(True))
    # a line that occurs once and has no near line needs no look at its occurrences
    fate = common.stored(distinct.select("h1", "h2", "first", "n").join(dropped, ["h1", "h2"], "left").filter("n > 1 OR near"), "line-fate")
    gone = all_lines.select("doc_id", "pos", "h1", "h2").join(fate, ["h1", "h2"]).filter(F.col("near").isNotNull() | (_order() != F.col("first")))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "h1")).alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The text without the removed lines; unchanged where none is removed."""
    out = F.filter(_split(text), lambda line, i: ~F.array_contains(gone, F.struct(i.alias("pos"), F.xxhash64(_bare(line)).alias("h1"))))
    return F.when(gone.isNull(), text).otherwise(F.array_join(out, "\n"))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, with the removed lines cut out of the text; the rows stay."""
    gone = removed(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, exact_chars=exact_chars).select(F.col("doc_id").alias("_gone_id"), F.col("gone").alias("_gone"))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]), "left")
    return joined.select(*[_kept(docs[c], F.col("_gone")).alias(c) if c == text_col else docs[c] for c in docs.columns])


def op8(spark, sf_dir: str) -> DataFrame:
    """For each document: doc_id, n_lines, n_removed, n_bytes (kept), kept_sha256."""
    docs = common.table(spark, sf_dir, "documents")
    plain = common.texts(docs)
    gone = removed(docs).select(F.col("doc_id").alias("_id"), "gone")
    joined = plain.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "gone", _kept(F.col("text"), F.col("gone")).alias("kept"))
    n_removed = F.size(F.filter(_split(F.col("text")), lambda line, i: F.array_contains(F.col("gone"), F.struct(i.alias("pos"), F.xxhash64(_bare(line)).alias("h1")))))
    return joined.select(
        "doc_id", F.size(_split(F.col("text"))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(n_removed).cast("long").alias("n_removed"),
        F.octet_length("kept").cast("long").alias("n_bytes"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = rf"""
WITH l AS (
  SELECT doc_id, i - 1 AS pos, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents), unnest(range(1, len(a) + 1)) AS u(i), unnest([a[i]]) AS w(raw)),
f AS (SELECT line, min((doc_id, pos)) AS first, row_number() OVER () AS id FROM l WHERE length(line) >= {EXACT_CHARS} GROUP BY line),
v AS (SELECT id, first, length(line) AS n, i, hash(substr(line, 1, i - 1) || substr(line, i + 1)) AS h FROM f, unnest(range(1, length(line) + 1)) AS u(i) WHERE length(line) >= {MIN_CHARS}),
w AS (SELECT id, first, length(line) AS n, hash(line) AS h FROM f WHERE length(line) >= {MIN_CHARS}),
c AS (
  SELECT DISTINCT b.id AS a, a.id AS e FROM v a JOIN v b ON a.h = b.h AND a.i = b.i AND a.n = b.n AND a.first < b.first
  UNION SELECT b.id, a.id FROM w a JOIN v b ON a.h = b.h AND a.n = b.n - 1 AND a.first < b.first
  UNION SELECT b.id, a.id FROM v a JOIN w b ON a.h = b.h AND a.n = b.n + 1 AND a.first < b.first),
near AS (SELECT DISTINCT x.line FROM c JOIN f x ON x.id = c.a JOIN f y ON y.id = c.e WHERE levenshtein(x.line, y.line) = 1),
r AS (
  SELECT l.*, length(line) >= {EXACT_CHARS} AND (line IN (FROM near) OR (doc_id, pos) <> f.first) AS gone
  FROM l LEFT JOIN f USING (line)),
k AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE coalesce(gone, false)) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(gone, false)), '') AS kept
  FROM r GROUP BY doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, octet_length(encode(kept))::BIGINT AS n_bytes, sha256(kept) AS kept_sha256 FROM k
"""
