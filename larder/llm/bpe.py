"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never end up inside one token, so a text
can be cut there with certainty.  No merge crosses such a cut, hence the fragments are encoded on their own and their ids
concatenated; the result is that of encoding the whole text.  White space (which the tokenizer drops) and the borders of
its pre-tokens cut as well.  Fragments and words repeat, so a task keeps the ids of those it has met.

Input: id and text.  NULL text is empty; an empty text has no ids and decodes to the empty string; repeated rows give
repeated rows; an empty table gives an empty one.  Special tokens written out in a text get their special ids, as in the
tokenizers library's default.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Sequence
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField
from tokenizers import Tokenizer
from tokenizers.models import BPE

from larder.llm.common import corpus, per_document
from larder.llm.pair_merges import PairMerges

WORD_BPE = "word_bpe_49k.json"
# Words whose ids a Python worker keeps, about 40 MB with their pieces; the store is emptied when it is full.
KEPT_WORDS = 1 << 17
# Longer pieces, in bytes, are merged on their own; the others many at once.
MERGED_AT_ONCE = 32

# The pre-token pattern of the tokenizer's file, used on words of Latin letters only: they are composed already and
# lower-case letter by letter.  Other words go through the tokenizer's own normalizer and pre-tokenizer.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LATIN = re.compile("[!-~\u00a1-\u024f]+")
_LATIN_LINES = re.compile("[!-~\u00a1-\u024f\n]*")
_OTHER, _LETTER, _DIGIT, _END = range(4)


@cache
def _kinds() -> np.ndarray:
    """What the pattern of pieces sees in each character that a word of Latin letters has in lower case."""
    kinds = np.full(0x3000, _OTHER, np.uint8)
    for i in range(len(kinds)):
        kinds[i] = _END if i == 10 else _LETTER if regex.match(r"\p{L}", chr(i)) else _DIGIT if regex.match(r"\p{N}", chr(i)) else _OTHER
    return kinds


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ForcedBoundaryCodec:
    def __init__(self, path: str, kept: int = KEPT_WORDS):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(pair) for pair in model["merges"]]
        self.inner = BPE(self.vocab, merges)  # fragments before the last: no word end
        self.final = BPE(self.vocab, merges, end_of_word_suffix=self.suffix) if self.suffix else self.inner
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        joins = {left + right for token in self.vocab for left, right in zip(self._bare(token), self._bare(token)[1:])}
        self.joins = joins  # pairs of letters met inside a token; every other pair is a cut
        self.marks = re.compile("|".join(re.escape(s) for s in self.special)) if self.special else None
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.kept = kept
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.together: dict[str, bytes] = {}  # words met by encode_all
        self.merges: PairMerges | None = None

    def _bare(self, token: str) -> str:
        return token.removesuffix(self.suffix) if self.suffix else token

    def fragments(self, letters: str) -> list[str]:
        """A pre-token cut wherever a pair of letters is in no token."""
        out, start, joins = [], 0, self.joins
        for i in range(1, len(letters)):
            if letters[i - 1 : i + 1] not in joins:
                out.append(letters[start:i])
                start = i
        return [*out, letters[start:]]

    def _pre_token(self, letters: str) -> bytes:
        ids = self.pieces.get(letters)
        if ids is None:
            cut = self.fragments(letters)
            ids = [t.id for f in cut[:-1] for t in self.inner.tokenize(f)] + [t.id for t in self.final.tokenize(cut[-1])]
            ids = np.array(ids, "<u4").tobytes()
            if len(self.pieces) >= self.kept:
                self.pieces.clear()
            self.pieces[letters] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if _LATIN.fullmatch(text):
            parts = [p.encode("utf-8").decode("latin-1").translate(self.letters) for p in _PIECES.findall(text.lower())]
        else:
            parts = [p for p, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]
        packed = b"".join([self._pre_token(p) for p in parts])
        if len(self.words) >= self.kept:
            self.words.clear()
        self.words[word] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        words = text.encode("utf-8").split()  # ASCII white space; other kinds fall in the pre-tokenizer
        known = self.words
        return b"".join([known.get(w) or self._word(w) for w in words])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.marks is None or "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _pair_merges(self) -> PairMerges:
        if self.merges is None:
            with open(self.path, encoding="utf-8") as file:
                merges = json.load(file)["model"]["merges"]
            letters, vocab = byte_letters(), self.vocab
            bare, last = (np.array([vocab[letters[b] + end] for b in range(256)]) for end in ("", self.suffix))
            self.merges = PairMerges(bare, last, ((vocab[a], vocab[b], vocab[a + b]) for a, b in merges))
        return self.merges

    def _words_together(self, words: list[str]) -> None:
        """Puts the ids of words into the store; those of Latin letters are merged all at once."""
        joined = "\n".join(words)
        if "'" in joined or not _LATIN_LINES.fullmatch(joined):
            alike = [_LATIN.fullmatch(w) is not None and "'" not in w for w in words]
            for word in compress(words, map(operator.not_, alike)):
                self.together[word] = self._word(word.encode("utf-8"))
            words = list(compress(words, alike))
            joined = "\n".join(words)
        if not words:
            return
        data = np.frombuffer((joined.lower() + "\n").encode("utf-8"), np.uint8)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of letters
        kind = _kinds().take(np.frombuffer((joined.lower() + "\n").encode("utf-32-le"), "<u4"))
        begins = (kind == _DIGIT) | (kind == _END)
        begins[1:] |= kind[1:] != kind[:-1]
        begins[0] = True
        border, ends = at[begins], kind[begins] == _END
        start, length = border[:-1][~ends[:-1]], np.diff(border)[~ends[:-1]]
        short = np.flatnonzero(length <= MERGED_AT_ONCE)
        ids, counts = self._pair_merges().merge(data, start[short], length[short])
        if len(short) < len(start):
            ids, counts = self._with_long(data, start, length, short, ids, counts)
        pieces = np.append(0, np.cumsum(~ends)[ends])  # of all words before
        edges = 4 * np.append(0, np.cumsum(counts))[pieces]
        packed, edges = ids.astype("<u4").tobytes(), edges.tolist()
        self.together.update(zip(words, map(packed.__getitem__, map(slice, edges, edges[1:]))))

    def _with_long(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, short: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, from those of the short ones."""
        parts: list[np.ndarray] = [ids[:0]] * len(start)
        for i, part in zip(short.tolist(), np.split(ids, np.cumsum(counts)[:-1])):
            parts[i] = part
        for i in np.setdiff1d(np.arange(len(start)), short).tolist():
            piece = data[start[i] : start[i] + length[i]].tobytes()
            parts[i] = np.frombuffer(self._pre_token(piece.decode("latin-1").translate(self.letters)), "<u4")
        return np.concatenate(parts), np.array(list(map(len, parts)))

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """What ``encode`` gives for each text; words of all texts that the store lacks are merged together."""
        apart = {i for i, t in enumerate(texts) if self.marks is not None and "<|" in t and self.marks.search(t)}
        plain = pa.array(["" if i in apart else t for i, t in enumerate(texts)], pa.large_string())
        lines = pc.ascii_split_whitespace(plain)
        flat = lines.flatten().dictionary_encode()
        known, words = self.together, flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.kept:  # words met again stay
            self.together = known = {w: known[w] for w in words if w in known}
        known[""] = b""
        if new:
            self._words_together([w for w in new if w])
        packed = list(map(known.__getitem__, words))
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        codes = flat.indices.to_numpy()
        own, first = sizes[codes], (np.cumsum(sizes) - sizes)[codes]
        behind = np.append(0, np.cumsum(own))
        ids = np.frombuffer(b"".join(packed), "<u4").take(np.repeat(first - behind[:-1], own) + np.arange(behind[-1]))
        edges = behind[lines.offsets.to_numpy() - lines.offsets[0].as_py()].tolist()
        return [self.encode(t) if i in apart else ids[edges[i] : edges[i + 1]].tobytes() for i, t in enumerate(texts)]

    def decode(self, packed: bytes) -> str:
        """The tokens with a space between them: the tokenizer's file states no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


_CODECS: dict[str, ForcedBoundaryCodec] = {}


def codec(path: str) -> ForcedBoundaryCodec:
    """One codec per Python worker, so that the words it has met serve later tasks too."""
    if path not in _CODECS:
        _CODECS[path] = ForcedBoundaryCodec(path)
    return _CODECS[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Id and ``ids`` (little-endian unsigned 32-bit, packed) of every document; on request the text ``decoded`` from them."""

    def make():
        code = codec(path)

        def work(texts):
            ids = [code.encode(t) for t in texts]
            return {"ids": ids, "decoded": [code.decode(i) for i in ids] if decoded else []}

        return work

    fields = [StructField("ids", BinaryType())] + [StructField("decoded", StringType())] * decoded
    return per_document(df, make, fields, id_col, text_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Id and ``decoded`` text of packed ids."""
    code_path = path

    def run(batches):
        import pandas as pd

        code = codec(code_path)
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "decoded": [code.decode(i or b"") for i in b[ids_col]]})

    return df.select(id_col, ids_col).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, decoded string")


def digests(df: DataFrame, path: str) -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them."""
    return encode(df, path, decoded=True).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op1_bpe(spark, folder: str) -> DataFrame:
    return digests(corpus(spark, folder), public_tokenizers.path(WORD_BPE))
