"""BPE encoding and decoding with a public tokenizer file, exact to the id.

The file's normalizer and splitting rule are the tokenizers library's; the
merging is done here, by dynamic programming over the prefixes of a piece.
For every prefix there is exactly one token that ends its encoding: among
the vocabulary tokens that are suffixes of the prefix (found by an
Aho-Corasick automaton over the vocabulary) it is the one that is compatible with the
last token of what stands before it.  The encoding of the piece is read off
by following these last tokens back from its end.

Compatibility.  Merges apply by rank, and a merge that makes a token ranks
after those that made its parts.  So when rank r is due, the symbol left of
a boundary between tokens s and t is a node of s's right spine and the one
right of it a node of t's left spine.  The boundary survives unless some
pair (x, y) of such nodes has a merge that comes before x and y are used up
by their own parents; of equal ranks the leftmost comes first.

Text is cut into pieces, or at white space, which the file's rule drops; a
chunk is encoded once and kept in a bounded table, so a document costs a
look-up a word.

Defined results: null and empty texts have no tokens and decode to the
empty string; special tokens' strings in a text are special tokens, as the
library has it by default; rows are independent, so repeats and ties need
no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.workers import map_batches, slices

#: Stands for the end of a word in the automaton; byte-level symbols never use it.
_END = "\t"
#: Chunks that a worker remembers at least; at twice this number the older half goes.
REMEMBERED = 250_000
#: The same for tasks that return ids, which share their worker's memory with other stages.
REMEMBERED_IDS = 40_000
#: Longest chunk that is remembered, so that the table is bounded in bytes too; longer ones are encoded each time.
LONGEST = 64
_CONTROL = re.compile("[\x1c-\x1f]")
#: Unicode white space; str.split() also splits at \x1c-\x1f, which the file's rule doesn't drop.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")


def default_path() -> str:
    """The public 49k word vocabulary's file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _symbols() -> dict[int, str]:
    """Byte-level BPE's symbol of every byte: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_SYMBOL = _symbols()
#: Below this character texts are in normal form and lower-cased character by character.
_PLAIN_END = "\u0130"


def _plain_pattern() -> re.Pattern:
    """The file's splitting rule for lower-case texts below ``_PLAIN_END``."""
    of = {k: "".join(re.escape(chr(c)) for c in range(33, 0x180) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{of['L']}]+|[{of['N']}]|[^{of['L']}{of['N']}\\t-\\r \\x85\\xa0]+")


_PLAIN = _plain_pattern()


class _Remembered:
    """A table of the last ``limit`` to twice as many entries: when the new half is full it becomes the old one."""

    def __init__(self, limit: int):
        self.new, self.old, self.limit = {}, {}, limit

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value
        return value


class WordBpe:
    """A BPE vocabulary with word ends."""

    def __init__(self, path: str, written: bool = False, remembered: int | None = None):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        known = Tokenizer.from_file(path)
        self._normalize, self._split = known.normalizer.normalize_str, known.pre_tokenizer.pre_tokenize_str
        self.written = written
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            self._rank[left, right] = rank
            self._parts.setdefault(made, (left, right, rank))
        self._spines: tuple[dict, dict] = ({}, {})
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._decimal = {i: str(i) for i in self.names}
        self._build_automaton()
        self.remembered = remembered or REMEMBERED
        self._chunks = _Remembered(self.remembered)

    def _build_automaton(self) -> None:
        import ahocorasick

        self._automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if not self.is_whole(i):
                continue
            if token.endswith(self.suffix) and len(token) > len(self.suffix):
                token = token[: -len(self.suffix)] + _END
            self._automaton.add_word(token, i << 8 | len(token))
        self._automaton.make_automaton()

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Nodes of the token's left (0) or right (1) spine, each with the rank of the merge that uses it up."""
        nodes = self._spines[side].get(token)
        if nodes is None:
            nodes = [(token, float("inf"))]
            at = token
            while at in self._parts:
                until, at = self._parts[at][2], self._parts[at][side]
                nodes.append((at, until))
            self._spines[side][token] = nodes
        return nodes

    def _stays_apart(self, s: int, t: int, but: tuple[int, int] | None = None) -> bool:
        due_of = self._rank.get
        left = self._spine(t, 0)
        for x, x_until in self._spine(s, 1):
            for y, y_until in left:
                due = due_of((x, y))
                if due is not None and due < x_until and due <= y_until and (x, y) != but:
                    return False
        return True

    def is_whole(self, token: int) -> bool:
        """Whether the token's own string is encoded as this one token."""
        known = self._whole.get(token)
        if known is None:
            if token not in self._parts:
                known = True
            else:
                a, b, _ = self._parts[token]
                known = self.is_whole(a) and self.is_whole(b) and self._stays_apart(a, b, but=(a, b))
            self._whole[token] = known
        return known

    def compatible(self, s: int, t: int) -> bool:
        """Whether the joined strings of two tokens are encoded as just these two."""
        pair = s << 20 | t
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) > 8 * self.remembered:
                self._fits.clear()
            known = self._fits[pair] = self._stays_apart(s, t)
        return known

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of byte-level symbols."""
        n = len(piece)
        if not n:
            return ()
        # By length of the prefix, the word's end counted as a symbol; no prefix may stop between the last symbol and the end.
        last, starts = [-1] * (n + 2), [0] * (n + 2)
        last[n] = 0
        fits, compatible = self._fits.get, self.compatible
        for end, code in self._automaton.iter(piece + _END):
            end += 1
            if last[end] < 0:
                start, token = end - (code & 255), code >> 8
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fit = fits(before << 20 | token)
                    if not (compatible(before, token) if fit is None else fit):
                        continue
                last[end], starts[end] = token, start
        out, at = [], n + 1
        while at:
            out.append(last[at])
            at = starts[at]
        out.reverse()
        return tuple(out)

    def pieces(self, chunk: str) -> list[str]:
        """Byte-level pieces of a text without white space and special tokens."""
        if chunk.isprintable() and (chunk.isascii() or max(chunk) < _PLAIN_END):
            found = _PLAIN.findall(chunk.lower())
            return found if chunk.isascii() else [x.encode().decode("latin-1").translate(_SYMBOL) for x in found]
        return [x for x, _ in self._split(self._normalize(chunk))]

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a text without white space and special tokens."""
        pieces = self.pieces(chunk)
        return self.encode_piece(pieces[0]) if len(pieces) == 1 else tuple([i for p in pieces for i in self.encode_piece(p)])

    def _entry(self, chunk: str) -> tuple:
        """A chunk's ids; with ``written`` in decimal, and the tokens' names, each joined by blanks."""
        known = self._chunks.get(chunk)
        if known is None:
            known = (self.special[chunk],) if chunk in self.special else self.encode_chunk(chunk)
            if self.written:
                decimal, names = self._decimal, self.names
                known = (" ".join([decimal[i] for i in known]), " ".join([names[i] for i in known]))
            if len(chunk) <= LONGEST:
                self._chunks.put(chunk, known)
        return known

    def chunks(self, text: str | None) -> list[tuple]:
        """Entries (see ``_entry``) of the chunks of a whole text, in order."""
        if not text:
            return []
        parts = self._special.split(text) if self._special and "<|" in text and any(s in text for s in self.special) else [text]
        out = []
        for part in parts:
            if part in self.special:
                words = [part]
            else:
                try:
                    part.encode("latin-1")  # in normal form and lower-cased character by character: cut into pieces at once
                    words = _PLAIN.findall(part.lower())
                except UnicodeEncodeError:
                    words = part.split() if not _CONTROL.search(part) else [w for w in _WHITE.split(part) if w]
            known, entry = self._chunks.new.get, self._entry
            out += [x if (x := known(w)) is not None else entry(w) for w in words]
        return out

    def encode(self, text: str | None) -> list[int]:
        if self.written:
            return [int(i) for x in self.chunks(text) for i in x[0].split()]
        return [i for x in self.chunks(text) for i in x]

    def decode(self, ids) -> str:
        """The tokens' names joined by blanks: the file names no decoder."""
        names = self.names
        return " ".join([names[i] for i in ids])


_LOADED: dict[tuple[str, bool], WordBpe] = {}


def load(path: str, written: bool = False) -> WordBpe:
    """The vocabulary of a file, read once by each worker."""
    if (path, written) not in _LOADED:
        _LOADED[path, written] = WordBpe(path, written)
    return _LOADED[path, written]


def encode_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of tokens, SHA-256 of the decimal ids joined by blanks, SHA-256 of the decoded text."""
    path = path or default_path()

    def run(batches):
        bpe = load(path, written=True)
        for part in slices(batches):
            rows = []
            for text in part.column(1).to_pylist():
                found = bpe.chunks(text)
                ids, names = " ".join([x[0] for x in found if x[0]]), " ".join([x[1] for x in found if x[0]])
                rows.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(names.encode()).hexdigest()))
            n, a, b = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every document.

    Null and empty texts have no ids; a null id is carried through; repeated
    rows are encoded alike; an empty table gives an empty result.
    """
    path = path or default_path()

    def run(batches):
        bpe = WordBpe(path, remembered=REMEMBERED_IDS)  # of this task only
        for part in slices(batches):
            found = [bpe.encode(t) for t in part.column(1).to_pylist()]
            ids = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, found), pa.int64()), ids], ["doc_id", "n_tokens", "ids"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the decoded text of rows with token ids; null ids: empty text."""
    path = path or default_path()

    def run(batches):
        bpe = load(path)
        for part in slices(batches):
            texts = pa.array([bpe.decode(ids or []) for ids in part.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), texts], ["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_batches(narrow, run, "doc_id long, text string")
