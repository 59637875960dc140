"""BPE encoding and decoding with forced boundaries.

Two bytes that never stand side by side inside any token of the vocabulary can't be merged across, whatever surrounds
them: between them lies a certain cut. White space and the pre-tokenizer's pieces give further certain cuts. `Codec`
splits a text at those cuts, encodes each fragment by itself and concatenates. Cuts are found for many texts at once by
look-ups of byte pairs; ids of fragments, and of the runs between white space that they make up, are kept for later texts.

What is kept is bounded by two generations of KEPT entries or KEPT_BYTES each: when the younger is full it becomes the older, and what
the older still held unused is forgotten and would be encoded again.

The vocabulary file is a parameter, read on each executor. Its pre-tokenizer, normalizer and decoder are compared with
those that the fast splitting assumes (WORDS_ONLY). Any other byte-level BPE is split by its own normalizer and
pre-tokenizer, then at forced cuts; a model that is not plain BPE over bytes is left to its own tokenizer.

Nulls and empty texts: no ids, an empty decoded text. Very long texts are encoded whole; memory holds one batch's ids, or
one document's. Repeated rows give one row each; an empty table gives an empty result; columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.common import table

VOCABULARY = "word_bpe_49k.json"
#: Entries of a generation that a worker keeps, some 200 bytes each.
KEPT = 300_000
#: Texts and bytes encoded together.
BATCH, BATCH_BYTES = 500, 4 << 20
#: Bytes of the keys and ids of a generation.
KEPT_BYTES = 32 << 20
#: Stands between runs that are normalized together; runs that hold it go to the tokenizer itself.
MARK = ""
_CONTRACTIONS = ((b"s", b"t", b"m", b"d"), (b"re", b"ve", b"ll"))
# The parts of a vocabulary file that the fast splitting assumes.
WORDS_ONLY = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
    "post_processor": None,
}
BLANK, LETTER, DIGIT, OTHER = range(4)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The usual letter for each byte in byte-level vocabularies: printable ones stand for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of stretches, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Names(dict):
    """Numbers keys in the order in which they are first asked for; `fresh` holds the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        self.fresh.append(key)
        return n


class Pool:
    """Ids by key, kept for two generations."""

    def __init__(self) -> None:
        self.now: tuple[Names, np.ndarray, np.ndarray, np.ndarray] = self._empty()
        self.before = self._empty()
        self.held = 0

    @staticmethod
    def _empty() -> tuple[Names, np.ndarray, np.ndarray, np.ndarray]:
        return Names(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, keys: list, make: Callable[[list], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of each key's ids, and the ids one after another. make gives both for new keys."""
        if len(self.now[0]) > KEPT or self.held > KEPT_BYTES:
            self.before, self.now, self.held = self.now, self._empty(), 0
        names, starts, sizes, ids = self.now
        at = np.fromiter(map(names.__getitem__, keys), np.int64, len(keys))
        if names.fresh:
            fresh, names.fresh = names.fresh, []
            old, old_starts, old_sizes, old_ids = self.before
            where = np.fromiter((old.get(k, -1) for k in fresh), np.int64, len(fresh))
            known = where >= 0
            new_sizes = np.zeros(len(fresh), np.int64)
            made_sizes, made = make([k for k, x in zip(fresh, known.tolist(), strict=True) if not x])
            new_sizes[known], new_sizes[~known] = old_sizes[where[known]], made_sizes
            new_starts = np.cumsum(new_sizes) - new_sizes
            new_ids = np.zeros(int(new_sizes.sum()), np.int32)
            new_ids[stretches(new_starts[known], new_sizes[known])] = old_ids[stretches(old_starts[where[known]], old_sizes[where[known]])]
            new_ids[stretches(new_starts[~known], made_sizes)] = made
            starts, sizes, ids = np.concatenate([starts, new_starts + len(ids)]), np.concatenate([sizes, new_sizes]), np.concatenate([ids, new_ids])
            self.now = (names, starts, sizes, ids)
            self.held += sum(map(len, fresh)) + new_ids.nbytes
        n = sizes[at]
        return n, ids[stretches(starts[at], n)]


class Codec:
    """Encodes and decodes like the vocabulary's own tokenizer without special tokens, padding or truncation."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        letters = byte_letters()
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
        #: Whether forced cuts hold: plain BPE over the letters of bytes.
        self.cut = model.get("type") == "BPE" and not any(model.get(k) for k in odd) and steps[-1].get("type") == "ByteLevel" and not spec.get("post_processor")
        #: Whether runs between ASCII white space can be split and kept by themselves.
        plain = all(not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")) and len(t["content"].split()) == 1 for t in spec.get("added_tokens", []))
        self.words_only = self.cut and plain and all(spec.get(k) == v for k, v in WORDS_ONLY.items())
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether ids decode to their tokens with blanks between them, special ones included.
        self.joins = spec.get("decoder") is None
        self.tokens = {i: t.encode() for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        if self.cut:
            self._prepare(model, letters)
        #: Decimal ids.
        self.decimal = [str(i).encode() for i in range(max(self.tokens, default=-1) + 1)]
        self.runs, self.last, self.inner = Pool(), Pool(), Pool()
        self.classes = np.full(0x110000, 255, np.uint8)
        self.classes[ord(MARK)] = BLANK

    def _prepare(self, model: dict, letters: dict[str, int]) -> None:
        """Encoders of fragments that end a piece and of those that don't, and the byte pairs that some token holds."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        suffix = model.get("end_of_word_suffix") or ""
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ends, self.goes_on = Tokenizer(models.BPE(vocab, merges, **({"end_of_word_suffix": suffix} if suffix else {}))), Tokenizer(models.BPE(vocab, merges))
        for t in (self.ends, self.goes_on):
            t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.joined = np.zeros((256, 256), bool)
        for t in vocab:
            raw = [letters.get(c, 0) for c in (t.removesuffix(suffix) if suffix else t)]
            self.joined[raw[:-1], raw[1:]] = True
        self.letter = {b: c for c, b in letters.items()}  # for str.translate on bytes read as Latin-1
        self.byte = {ord(c): b for c, b in letters.items()}

    # Fragments

    def _encoded(self, coder) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
        def make(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
            if not names:
                return np.zeros(0, np.int64), np.zeros(0, np.int32)
            e = coder.encode(" ".join(names))
            return np.bincount(np.array(e.word_ids, np.int64), minlength=len(names)), np.array(e.ids, np.int32)

        return make

    def _fragments(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each fragment starts, the size of its ids and the ids, one after another. raw: bytes of pieces one after
        another; ends: whether a piece ends with each byte."""
        cut = ends.copy()
        cut[:-1] |= ~self.joined[raw[:-1], raw[1:]]
        stops = np.flatnonzero(cut)
        text = raw.tobytes().decode("latin-1").translate(self.letter)
        starts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else np.zeros(0, np.int64)
        names = [text[a:b] for a, b in zip(starts.tolist(), (stops + 1).tolist(), strict=True)]
        final = ends[stops]
        sizes = np.zeros(len(names), np.int64)
        found = []
        for coder, pool, mine in ((self.ends, self.last, final), (self.goes_on, self.inner, ~final)):
            n, ids = pool.find([names[i] for i in np.flatnonzero(mine).tolist()] if not mine.all() else names, self._encoded(coder))
            sizes[mine] = n
            found.append((mine, n, ids))
        at = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int32)
        for mine, n, ids in found:
            out[stretches(at[mine], n)] = ids
        return starts, sizes, out

    # Runs between white space

    def _class(self, points: np.ndarray) -> np.ndarray:
        """Classes of code points, as the pre-tokenizer itself has them."""
        out = self.classes[points]
        if (out == 255).any():
            pre = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for p in np.unique(points[out == 255]).tolist():
                c = chr(p)
                alone = len(pre(c + c))
                self.classes[p] = BLANK if alone == 0 else DIGIT if alone == 2 else LETTER if len(pre("a" + c)) == 1 else OTHER
            out = self.classes[points]
        return out

    def _ends(self, raw: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a piece ends with each byte. kind: its character's class; bytes of one digit end together."""
        ends = np.ones(len(raw), bool)
        ends[:-1] = kind[1:] != kind[:-1]
        lead = (raw & 0xC0) != 0x80
        ends[:-1] |= (kind[:-1] == DIGIT) & lead[1:]
        # An apostrophe that starts a run of other characters takes a contraction's letters along.
        quote = np.flatnonzero((raw[:-1] == 39) & (kind[1:] == LETTER))
        quote = quote[(quote == 0) | (kind[quote - 1] != OTHER)]
        for letters in _CONTRACTIONS:
            n = len(letters[0])
            q = quote[quote + n < len(raw)]
            text = raw.tobytes() if len(q) else b""
            for p in (p for p in q.tolist() if text[p + 1 : p + 1 + n] in letters):
                ends[p], ends[p + n] = False, True
        return ends

    def _pieces(self, runs: list[bytes], ascii_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the runs' pieces, whether a piece ends with each, and the run that each is in."""
        if ascii_only:
            raw = np.frombuffer(b" ".join(runs).lower(), np.uint8)
            kind = self._class(raw)
            run = np.cumsum(raw == 32)
        else:
            norm = self.tokenizer.normalizer.normalize_str(MARK.join(r.decode() for r in runs))
            raw = np.frombuffer(norm.encode(), np.uint8)
            points = np.frombuffer(norm.encode("utf-32-le"), "<u4")
            of = np.cumsum((raw & 0xC0) != 0x80) - 1
            kind, run = self._class(points)[of], np.cumsum(points == ord(MARK))[of]
        keep = kind != BLANK
        return raw[keep], self._ends(raw, kind)[keep], run[keep]

    def _make_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of runs of text without ASCII white space, past whose ends no token reaches."""
        groups: tuple[list[int], list[int], list[int]] = ([], [], [])
        mark = MARK.encode()
        for i, r in enumerate(runs):
            groups[2 if mark in r or any(s in r for s in self.special) else 0 if r.isascii() else 1].append(i)
        sizes = np.zeros(len(runs), np.int64)
        found = []
        for k in (0, 1):
            if groups[k]:
                raw, ends, run = self._pieces([runs[i] for i in groups[k]], k == 0)
                starts, n, ids = self._fragments(raw, ends)
                at = np.array(groups[k])
                sizes[at] = np.bincount(run[starts], n, len(at)).astype(np.int64)
                found.append((at, ids))
        for i in groups[2]:
            ids = np.array(self.tokenizer.encode(runs[i].decode(), add_special_tokens=False).ids, np.int32)
            sizes[i] = len(ids)
            found.append((np.array([i]), ids))
        place = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int32)
        for at, ids in found:
            out[stretches(place[at], sizes[at])] = ids
        return sizes, out

    # Whole texts

    def _by_pieces(self, text: bytes) -> np.ndarray:
        """Ids of a text by the vocabulary's own normalizer and pre-tokenizer, and forced cuts within pieces."""
        if not self.cut or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
        norm, pre = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        parts = [p for p, _ in pre.pre_tokenize_str(norm.normalize_str(text.decode()) if norm else text.decode())]
        raw = np.frombuffer("".join(parts).translate(self.byte).encode("latin-1"), np.uint8)
        ends = np.zeros(len(raw), bool)
        ends[np.cumsum([len(p) for p in parts if p], dtype=np.int64) - 1] = True
        return self._fragments(raw, ends)[2]

    def batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of each text's ids, and the ids one after another."""
        if not self.words_only:
            each = [self._by_pieces(t) for t in texts]
            return np.array([len(x) for x in each], np.int64), np.concatenate([np.zeros(0, np.int32), *each])
        split = [t.split() for t in texts]
        n, ids = self.runs.find([r for s in split for r in s], self._make_runs)
        total = np.concatenate([[0], np.cumsum(n)])
        last = np.cumsum([len(s) for s in split], dtype=np.int64)
        return np.diff(total[last], prepend=0), ids

    def encode(self, text: str | None) -> list[int]:
        return self.batch([(text or "").encode()])[1].tolist()

    def decode(self, ids: list[int]) -> bytes:
        """As the tokenizer's decode with special tokens: without a decoder, tokens joined by one blank."""
        if not self.joins:
            return self.tokenizer.decode(ids, skip_special_tokens=False).encode()
        try:
            return b" ".join(map(self.tokens.__getitem__, ids))
        except KeyError:  # ids that name no token are left out
            return b" ".join(self.tokens[i] for i in ids if i in self.tokens)


_codecs: dict[str, Codec] = {}


def codec(path: str | None = None) -> Codec:
    """One codec for each vocabulary and worker."""
    path = path or vocabulary_path()
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _each(df: DataFrame, column: str, schema: str, fields: list[tuple[str, pa.DataType]], f: Callable[[Codec, list], list[tuple]], path: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)

        def rows(ids: list, held: list) -> pa.RecordBatch:
            cols = list(zip(*f(c, held), strict=True)) or [()] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(v, k) for v, (_, k) in zip(cols, fields, strict=True))], names=["doc_id", *(n for n, _ in fields)])

        for b in batches:
            ids, held, size = [], [], 0
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                value = x.as_py()
                value = (value or b"") if column == "text" else (value or [])
                if held and (len(held) == BATCH or size + len(value) > BATCH_BYTES):
                    yield rows(ids, held)
                    ids, held, size = [], [], 0
                ids.append(i)
                held.append(value)
                size += len(value)
            yield rows(ids, held)

    value = F.col("text").cast("binary") if column == "text" else F.col(column)
    return df.select(F.col("doc_id").cast("bigint"), value).mapInArrow(run, "doc_id bigint, " + schema)


def _documents(c: Codec, texts: list[bytes]) -> Iterator[list[int]]:
    sizes, ids = c.batch(texts)
    every, at = ids.tolist(), 0
    for n in sizes.tolist():
        yield every[at : at + n]
        at += n


def encode_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids of each whole text."""
    return _each(documents, "text", "ids array<int>", [("ids", pa.list_(pa.int32()))], lambda c, texts: [(x,) for x in _documents(c, texts)], path)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each row's ids."""
    return _each(encoded, "ids", "text string", [("text", pa.string())], lambda c, rows: [(c.decode(ids).decode(),) for ids in rows], path)


def digests(c: Codec, texts: list[bytes]) -> list[tuple[int, str, str]]:
    """Number and digest of each text's ids, and digest of what decode() makes of them."""
    decimal = c.decimal.__getitem__
    return [(len(ids), hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()) for ids in _documents(c, texts)]


def round_trip_digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """digests() of each document, without moving ids out of the task."""
    return _each(documents, "text", "n_tokens bigint, ids_sha256 string, decoded_sha256 string", [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())], digests, path)


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))
