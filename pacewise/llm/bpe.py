"""Op 1: exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one vocabulary token can come last in its encoding. A suffix
automaton over the vocabulary yields, while the word is read, the tokens that end at each
position; the token ``t`` ending at ``i`` is the last one iff the last token of the prefix before
it and ``t`` are a pair that merging would leave alone (``Vocabulary.compatible``). Following the
stored last tokens backwards emits the ids, without simulating any merge over the text.

Rows are independent, so the operator is a narrow Arrow map: no shuffle, and a lost executor costs
only its own input splits. Words repeat, so each Python worker keeps bounded caches (word -> ids and
prefix -> last tokens); emptying them changes the time, not the result.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pacewise.llm.common import appended, extend, pieces, texts, without

WORD_CACHE = 250_000      # words of one generation of a worker's cache (two are kept)
PREFIX_CACHE = 250_000    # word prefixes whose last tokens a worker keeps
PIECE_BYTES = 8 << 20     # text encoded before its ids are handed on
PAIR_CACHE = 500_000      # token pairs whose test a worker keeps
SHORT_WORD = 40           # longer symbol runs bypass the prefix cache
NEVER = 1 << 30

# Characters below U+0250 keep the same class and lower case in every Unicode version; the four
# information separators are left out because Python counts them as white space.
_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ]")
_END = "</w>"


def is_plain(text: str) -> bool:
    if text.isascii():
        return not any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _PLAIN.search(text) is None


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _latin_classes() -> tuple[str, str]:
    by = {"L": "", "N": ""}
    for c in map(chr, range(0x250)):
        kind = unicodedata.category(c)[0]
        if kind in by:
            by[kind] += re.escape(c)
    return by["L"], by["N"]


def plain_pretokens() -> re.Pattern[str]:
    """The file's word splitter for lower-cased text of plain characters without white space."""
    letters, numbers = _latin_classes()
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+")


class Vocabulary:
    """Tokens, merge ranks and the suffix automaton of a word-level byte BPE file.

    A word is a string of symbols: byte ``b`` is ``chr(b)``, and the byte that ends the word is
    ``chr(256 + b)``.
    """

    def __init__(self, spec: str) -> None:
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        data = json.loads(spec)
        model = data["model"]
        if model.get("end_of_word_suffix") != _END or model.get("unk_token") is not None:
            raise ValueError("the vocabulary must mark word ends with </w> and cover every byte")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {a["content"]: a["id"] for a in data["added_tokens"]}
        names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.names_utf8 = [n.encode() for n in self.names]
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pretokens = plain_pretokens()

        stand_in = byte_symbols()
        self.symbols: dict[str, int] = {}          # symbol string -> id
        for token, i in self.ids.items():
            end = token.endswith(_END) and token != _END
            body = token[: -len(_END)] if end else token
            if body and all(c in stand_in for c in body):
                s = "".join(chr(stand_in[c]) for c in body)
                self.symbols[s[:-1] + chr(ord(s[-1]) + 256) if end else s] = i
        self.rank = array("i", [-1]) * len(self.names)
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b, made = self.ids[left], self.ids[right], self.ids[left + right]
            if made in self.parts:
                raise ValueError("two merges make the same token")
            self.parts[made], self.rank[made], self.pair_rank[a, b] = (a, b), r, r
        self.pairs: dict[int, bool] = {}
        self.pairs_kept = PAIR_CACHE
        self._whole: dict[int, bool] = {}
        self._by_id = {i: s for s, i in self.symbols.items()}
        self.sizes = [len(self._by_id.get(i, "")) for i in range(len(self.names))]
        self._automaton()

    def _automaton(self) -> None:
        """Suffix automaton over all tokens; ``candidates[s]`` lists the tokens that end its strings."""
        link, length, step = array("i", [-1]), array("i", [0]), [{}]
        for token in self.symbols:
            last = 0
            for c in token:
                known = step[last].get(c)
                if known is not None and length[known] == length[last] + 1:
                    last = known
                    continue
                clone = -1
                if known is None:
                    new, p = len(link), last
                    link.append(0), length.append(length[last] + 1), step.append({})
                    while p >= 0 and c not in step[p]:
                        step[p][c] = new
                        p = link[p]
                    if p >= 0:
                        known = step[p][c]
                        if length[known] == length[p] + 1:
                            link[new] = known
                            last = new
                            continue
                        clone = len(link)
                    else:
                        last = new
                        continue
                else:
                    new, p, clone = -1, last, len(link)
                link.append(link[known]), length.append(length[p] + 1), step.append(dict(step[known]))
                while p >= 0 and step[p].get(c) == known:
                    step[p][c] = clone
                    p = link[p]
                link[known] = clone
                if new >= 0:
                    link[new] = clone
                last = new if new >= 0 else clone
        own: dict[int, list[tuple[int, int]]] = {}
        for token, i in self.symbols.items():
            s = 0
            for c in token:
                s = step[s][c]
            own.setdefault(s, []).append((len(token), i))
        # all tokens along the suffix links, longest first
        candidates: list[tuple[tuple[int, int], ...]] = [()] * len(link)
        for s in sorted(range(1, len(link)), key=length.__getitem__):
            candidates[s] = (*sorted(own.get(s, ()), reverse=True), *candidates[link[s]])
        self.link, self.length, self.step, self.candidates = link, length, step, candidates

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of ``a`` followed by that of ``b`` ends with exactly these two.

        Both tokens grow by merges of rising rank. At the border the pair of the parts built so
        far would merge first if its rank is below the next merge of the left part (the leftmost
        wins a tie) and not above that of the right part.
        """
        left, right = [a], [b]
        while left[-1] in self.parts:
            left.append(self.parts[left[-1]][1])
        while right[-1] in self.parts:
            right.append(self.parts[right[-1]][0])
        i, j = len(left) - 1, len(right) - 1
        while True:
            cross = self.pair_rank.get((left[i], right[j]), NEVER)
            next_left = self.rank[left[i - 1]] if i else NEVER
            next_right = self.rank[right[j - 1]] if j else NEVER
            if cross < next_left and cross <= next_right:
                return False
            if not i and not j:
                return True
            if next_left <= next_right:
                i -= 1
            else:
                j -= 1

    def _reachable(self, t: int) -> bool:
        """Whether the token's own text merges to it (plain merging, once for each token)."""
        ids = [self.symbols[c] for c in self._by_id[t]]
        while len(ids) > 1:
            r, k = min((self.pair_rank.get(p, NEVER), k) for k, p in enumerate(zip(ids, ids[1:], strict=False)))
            if r == NEVER:
                break
            made = next(m for m in (self.ids.get(self.names[ids[k]] + self.names[ids[k + 1]]),) if m is not None)
            ids[k: k + 2] = [made]
        return ids == [t]

    def fits(self, key: int, before: int, t: int) -> bool:
        if (ok := self._whole.get(t)) is None:
            ok = self._whole[t] = self._reachable(t)
        if len(self.pairs) > self.pairs_kept:
            self.pairs.clear()
        ok = self.pairs[key] = ok and (before < 0 or self.compatible(before, t))
        return ok


class Encoder:
    """Encodes and decodes texts with one vocabulary; keeps this worker's bounded caches."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.share = 1
        self.words = _Words(self)
        self.root, self.nodes = [{}, 0, 0, -1], 0

    def encode_symbols(self, w: str) -> list[int]:
        """Ids of one word given as symbols: last token of every prefix, then back-pointers.

        A node of the prefix cache is [children, automaton state, matched length, last token].
        """
        v, n = self.v, len(w)
        if self.nodes > PREFIX_CACHE // self.share:
            self.root, self.nodes = [{}, 0, 0, -1], 0
        node, path, k = self.root, [self.root], 0
        short = n <= SHORT_WORD
        if short:
            for c in w:
                if (child := node[0].get(c)) is None:
                    break
                path.append(child)
                node = child
            k = len(path) - 1
        if k < n:
            step, link, length, candidates, pairs = v.step, v.link, v.length, v.candidates, v.pairs
            state, matched = node[1], node[2]
            for i in range(k + 1, n + 1):
                c = w[i - 1]
                while (to := step[state].get(c)) is None:
                    state = link[state]
                    matched = length[state]
                state, matched = to, matched + 1
                for size, t in candidates[state]:
                    if size <= matched:
                        key = path[i - size][3] << 20 | t
                        if (ok := pairs.get(key)) is None:
                            ok = v.fits(key, path[i - size][3], t)
                        if ok:
                            break
                else:
                    raise ValueError("no token fits")
                child = [{}, state, matched, t]
                if short and i < n:
                    node[0][c] = child
                    self.nodes += 1
                path.append(child)
                node = child
        out, at, sizes = [], n, v.sizes
        while at:
            t = path[at][3]
            out.append(t)
            at -= sizes[t]
        out.reverse()
        return out

    def _pretoken(self, raw: bytes) -> list[int]:
        s = raw.decode("latin-1")
        return self.encode_symbols(s[:-1] + chr(ord(s[-1]) + 256))

    def _slow(self, text: str) -> bytes:
        """Text outside the plain range: the file's own normaliser and word splitter, then the same
        dynamic programming."""
        tok, back = self.v.library, byte_symbols()
        out = array("I")
        for piece, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text)):
            out.extend(self._pretoken(bytes(back[c] for c in piece)))
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" in text:
            return b"".join(self._special(p) if p in self.v.special else self._plain(p)
                            for p in self.v.special_at.split(text) if p)
        return self._plain(text)

    def _special(self, piece: str) -> bytes:
        return self.v.special[piece].to_bytes(4, "little")

    def _plain(self, text: str) -> bytes:
        if not is_plain(text):
            return self._slow(text)
        if len(self.words) > WORD_CACHE // self.share:
            self.words.older = dict(self.words)
            self.words.clear()
        return b"".join(map(self.words.__getitem__, text.lower().split()))

    def decode(self, ids: bytes) -> bytes:
        """Token strings joined by one space (the file has no decoder step), as UTF-8."""
        return b" ".join(map(self.v.names_utf8.__getitem__, memoryview(ids).cast("I")))


class _Words(dict):
    """Word -> ids; a missing word is cut into pretokens and encoded."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is not None:
            self[word] = ids
            return ids
        out = array("I")
        for p in self.encoder.v.pretokens.findall(word):
            out.extend(self.encoder._pretoken(p.encode()))
        ids = out.tobytes()
        if len(word) <= SHORT_WORD:
            self[word] = ids
        return ids


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(spec: str) -> Encoder:
    """This Python worker's encoder for a vocabulary file (built once, reused by later tasks)."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(spec))
        gc.freeze()  # the tables stay as long as the worker; scanning them again and again is waste
    return _ENCODERS[key]


def forget_encoders() -> None:
    """Gives back the memory of this worker's encoder (tables and caches)."""
    _ENCODERS.clear()
    gc.unfreeze()
    gc.collect()


def read_vocabulary(path: str) -> str:
    """The vocabulary file (a few MB, installed beside the code; its size is fixed by the file)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Adds ``ids``: the tokenizer library's ids of the whole text, little-endian uint32.

    Null and empty texts have no ids. Repeated rows stay. An input column named ``ids`` gives way.
    """
    return _mapped(df, vocabulary_path, text, decode=False)


def encode_decode(df: DataFrame, vocabulary_path: str, text: str = "text", lean: bool = False) -> DataFrame:
    """``encode`` plus ``decoded``: the ids decoded again, in the same pass over the rows.

    A ``lean`` worker keeps a quarter of the words, prefixes and pairs and gives its encoder's memory back
    after each task, for jobs whose other stages need it; else later tasks go on with what it knows.
    """
    return _mapped(df, vocabulary_path, text, decode=True, lean=lean)


def _mapped(df: DataFrame, vocabulary_path: str, text: str, decode: bool, lean: bool = False) -> DataFrame:
    if text.lower() in ("ids", "decoded"):
        raise ValueError("the text column may not be named like a result")
    kept = without(df, "ids", *["decoded"] * decode)
    spec = kept.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    fields = [T.StructField("ids", T.BinaryType())] + [T.StructField("decoded", T.StringType())] * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(spec.value)
        encoder.share = share = 4 if lean else 1
        encoder.v.pairs_kept = PAIR_CACHE // share
        for batch in batches:
            for piece in pieces(batch, text, PIECE_BYTES // share):
                ids = [encoder.encode(t) for t in texts(piece, text)]
                new = {"ids": pa.array(ids, pa.binary())}
                if decode:
                    new["decoded"] = pa.array([encoder.decode(i) for i in ids], pa.binary()).cast(pa.string())
                yield extend(piece, **new)
        if lean:
            del encoder
            forget_encoders()

    return kept.mapInArrow(run, appended(kept, *fields))


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` for a column of ids as written by ``encode`` (null: empty)."""
    if ids.lower() == "decoded":
        raise ValueError("the id column may not be named like a result")
    kept = without(df, "decoded")
    spec = kept.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(spec.value)
        for batch in batches:
            for piece in pieces(batch, ids):
                rows = piece.column(piece.schema.get_field_index(ids)).to_pylist()
                yield extend(piece, decoded=pa.array([encoder.decode(r or b"") for r in rows], pa.binary()).cast(pa.string()))

    return kept.mapInArrow(run, appended(kept, T.StructField("decoded", T.StringType())))
