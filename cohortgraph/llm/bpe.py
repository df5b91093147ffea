"""BPE encoding by backtracking, decoding by an offset table.

A word is encoded from left to right. The Aho-Corasick automaton lists the tokens that start at each
position; the longest is tried first and taken if it can stand beside the token before it. Two tokens
can stand side by side if no merge across their border comes before the merges that build them: this
is the pair-compatibility table, filled as pairs occur. If nothing fits, the last token is taken back
and the position is marked dead, so every position is tried a bounded number of times. The result is
exactly that of applying the merges in order of rank.

The tokenizer file is read by the driver and broadcast (its size is fixed, a few MB). Around the
encoder stand the file's own steps: special tokens are cut out first, then NFC, lower case, splitting
into contractions, letter runs, single digits and symbol runs, and the byte alphabet. There is no
decoder in the file, so decoding joins the token strings with a blank.

Defined cases: null or blank texts have no tokens and decode to an empty text; repeated rows give
repeated results.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortgraph.llm import common

NAME = "word_bpe_49k.json"
#: Keys in one generation of a worker's memory.
REMEMBERED = 150_000
#: Shift that marks the last symbol of a word.
_END = 0x10000
_SUFFIX = "</w>"
#: str.split() takes these for white space, the file's pattern does not.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def _byte_alphabet() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _marked(token: str) -> str:
    """A token string with its word end moved into the last symbol."""
    if not token.endswith(_SUFFIX) or token == _SUFFIX:
        return token
    body = token[: -len(_SUFFIX)]
    return body[:-1] + chr(ord(body[-1]) + _END)


class Encoder:
    """Encoder and decoder of one tokenizer file, given as its JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _SUFFIX or spec["decoder"] is not None:
            raise ValueError("not a word-end BPE file without decoder")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {k: np.uint32(v).tobytes() for k, v in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        #: White space is spelled out: the library's \s leaves out the separators U+001C to U+001F.
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+").findall
        self.alphabet = _byte_alphabet()
        self.spines: dict[tuple[int, int], tuple[tuple[int, float], ...]] = {}
        vocab = {_marked(t): i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged, self.parts = {}, {}  # pair of ids -> rank; id -> (left, right, rank)
        for rank, (left, right) in enumerate(merges):
            a, b, c = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            self.merged[a, b] = rank
            self.parts[c] = (a, b, rank)
        self.pair_ok: dict[tuple[int, int], bool] = {}
        whole = {i: i not in self.parts for i in vocab.values()}
        for token, (a, b, _) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            whole[token] = whole[a] and whole[b] and self._apart(a, b, top=False)
        usable = {token: i for token, i in vocab.items() if whole[i]}
        self.automaton = ahocorasick.Automaton()
        self.lengths = {i: len(token) for token, i in usable.items()}
        self.shorter = {}  # the longest other token that a token starts with, else -1
        for token, i in usable.items():
            self.automaton.add_word(token, (len(token) - 1, i))
            self.shorter[i] = next((usable[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in usable), -1)
        self.automaton.make_automaton()
        strings = [""] * (max([*model["vocab"].values(), *special.values()]) + 1)
        for t, i in [*model["vocab"].items(), *special.items()]:
            strings[i] = t
        raw = [s.encode() + b" " for s in strings]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.strings = np.frombuffer(b"".join(raw), np.uint8)
        self.words = _Memory(lambda word: np.array(self.word(word), "<u4").tobytes())
        self.runs = _Memory(lambda run: b"".join(map(self.words.__getitem__, self.pieces(run))))

    def _spine(self, token: int, side: int) -> tuple[tuple[int, float], ...]:
        """The tokens along one edge of a token's merge tree, each with the rank of the merge that takes it up."""
        key = (token, side)
        if key not in self.spines:
            out, at = [(token, float("inf"))], token
            while at in self.parts:
                out.append((self.parts[at][side], self.parts[at][2]))
                at = self.parts[at][side]
            self.spines[key] = tuple(out)
        return self.spines[key]

    def _apart(self, a: int, b: int, top: bool = True) -> bool:
        """No merge across the border of a and b comes first; top: also count the merge of a and b themselves."""
        right, merged = self._spine(b, 0), self.merged.get
        for x, x_rank in self._spine(a, 1):
            for y, y_rank in right:
                rank = merged((x, y))
                if rank is not None and rank < x_rank and rank <= y_rank and (top or (x, y) != (a, b)):
                    return False
        return True

    def word(self, piece: str) -> list[int]:
        """Token ids of one word, given as text."""
        symbols = piece.encode().decode("latin-1").translate(self.alphabet)
        symbols = symbols[:-1] + chr(ord(symbols[-1]) + _END)
        n = len(symbols)
        longest = {end - back: token for end, (back, token) in self.automaton.iter(symbols)}  # by start; longer ones come later
        token = longest[0]
        size, shorter, pair_ok = self.lengths, self.shorter, self.pair_ok
        if size[token] == n:
            return [token]
        dead: set[int] = set()
        out: list[int] = []
        at = 0
        while True:
            while token >= 0:
                if at + size[token] not in dead:
                    if not out:
                        break
                    pair = (out[-1], token)
                    ok = pair_ok.get(pair)
                    if ok is None:
                        ok = pair_ok[pair] = self._apart(*pair)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                if at == n:
                    return out
                token = longest[at]
            else:  # nothing fits here: take the last token back and try the next shorter one
                dead.add(at)
                token = out.pop()
                at -= size[token]
                token = shorter[token]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.cut is not None and "<|" in text:
            parts = self.cut.split(text)
        else:
            parts = [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                if _SEPARATORS.search(part):
                    out.extend(map(self.words.__getitem__, self.pieces(part)))
                else:  # no piece spans white space
                    out.extend(map(self.runs.__getitem__, part.split()))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The token strings joined by blanks, in UTF-8: the offset table says where each one stands."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[tokens] - (ends - sizes), sizes)
        return self.strings[at].tobytes()[:-1]


class _Memory(dict):
    """Remembers values of short keys in two generations: what is used again outlives a full memory."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


_BUILT: dict[str, Encoder] = {}


def _encoder(text: str) -> Encoder:
    """One encoder a worker process."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Encoder(text)
    return _BUILT[key]


def tokenizer_text(path: str | None = None) -> str:
    """The JSON text of a tokenizer file; by default the public word-end file of this environment."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(NAME)
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, ids: bool = True) -> DataFrame:
    """For each document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids as array<int>."""
    source = common.texts(docs, id_col, text_col)
    file = source.sparkSession.sparkContext.broadcast(tokenizer_text(path))

    def make():
        encoder = _encoder(file.value)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            coded = [encoder.encode(t) for t in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), pa.array([len(c) // 4 for c in coded], pa.int64()),
                       pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                       pa.array([hashlib.sha256(encoder.decode(c)).hexdigest() for c in coded], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        return step

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return common.map_arrow(source, make, schema)


def decode(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text) from token ids; null ids give an empty text."""
    source = tokens.selectExpr(f"`{id_col}` AS doc_id", f"coalesce(`{ids_col}`, array()) AS ids")
    file = source.sparkSession.sparkContext.broadcast(tokenizer_text(path))

    def run(batches):
        encoder = _encoder(file.value)
        for part in batches:
            out = [encoder.decode(np.array(x, "<u4").tobytes()).decode() for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text string")


def op10(spark, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "documents"), ids=False)
