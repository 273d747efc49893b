"""Encode and decode with a byte-pair vocabulary by splitting texts at forced boundaries.

A merge can only build tokens of the vocabulary, so two neighbouring bytes that no token holds side
by side are never merged: a cut between them is certain. A table of 256 x 256 bits marks the pairs
that some token holds. From it come, when a vocabulary is loaded, the cuts that are made everywhere,
where the vocabulary's pattern ends a part whatever follows: before ASCII white space, and between a
Latin letter and one of some common punctuation marks. Byte-level vocabularies without marks of word
ends are also cut inside long stretches without white space, at every character boundary whose pair
of bytes is absent, but not before an apostrophe, as the pattern reads contractions from there.
Vocabularies with word ends mark the last token of the whole word and forbid cuts inside.

Fragments are encoded independently, each distinct one once as long as a task remembers it, and
their ids are concatenated. Null and empty texts have no ids. Texts of any length pass whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from lexiform.llm.batches import chunks_of_text, record_batch

WHITE = " \t\n\r\x0b\x0c"
# White space to Python beyond the ASCII characters above.
OTHER_WHITE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# Letters that stay letters to their end when a vocabulary composes and lower-cases its texts.
STEADY = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
MARKS = ".,;:!?*#$%&|"
REMEMBERED = 600_000  # fragments that a worker keeps, in about 230 bytes each
REMEMBERED_CHARS = 48  # longer fragments are not kept
LONG_CHARS = 512  # fragments that are longer are cut inside
JOINED = 512  # words that are encoded as one text
SPACED_WORD = re.compile(r"[ \n]\S+")
LATIN_WORD = re.compile(r"[A-Za-z]+")
VOCABULARY_BYTES = 64_000_000  # a larger vocabulary file is not sent to the tasks


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def held_pairs(tokens: list[bytes]) -> np.ndarray:
    """Whether some token holds two bytes side by side: a table by first and second byte."""
    table = np.zeros((256, 256), bool)
    tokens = [t for t in tokens if t]
    data = np.frombuffer(b"".join(tokens), np.uint8)
    inside = np.ones(len(data), bool)
    inside[np.cumsum([len(t) for t in tokens], dtype=np.int64) - 1] = False
    left = np.flatnonzero(inside)
    table[data[left], data[left + 1]] = True
    return table


def plain_bytes(vocabulary: str) -> bool:
    """Whether a vocabulary takes texts as they are, in parts by the usual byte-level pattern, and
    its tokens do not depend on where a word ends."""
    settings = json.loads(vocabulary)
    model, parts = settings["model"], settings["pre_tokenizer"] or {}
    return (
        settings["normalizer"] is None
        and parts.get("type") == "ByteLevel" and parts.get("use_regex", True)
        and not parts.get("add_prefix_space")
        and model["type"] == "BPE" and not model.get("dropout")
        and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
    )


class FragmentCodec:
    """Encodes texts as the tokenizer of a vocabulary does, by fragments; decodes ids."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        by_id = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        alphabet = byte_alphabet()
        raw = [bytes(alphabet[c] for c in t if c in alphabet) for t in self.tokens]
        self.pairs = held_pairs(raw)
        self.inner = plain_bytes(vocabulary)
        # Bytes that end a character which is not white space, and some token holds before white space.
        worded = held_pairs([t for t in raw if not t.decode("utf-8", "replace").isspace()])
        white = np.frombuffer(WHITE.encode(), np.uint8)
        ends = np.array([b for b in range(256) if b not in white and b < 0xC0])
        held = ends[worded[np.ix_(ends, white)].any(axis=1)]
        self.plain = not len(held)
        after = "".join(re.escape(chr(b)) for b in held if b < 0x80)
        after += "\x80-\U0010ffff" if (held >= 0x80).any() else ""
        self.cuts = re.compile(rf"(?<=[^\s{after}])(?=[ \t-\r])")
        ascii_letters = np.array([b for b in range(128) if chr(b).isalpha()])
        marks = "".join(m for m in MARKS if not self.pairs[ascii_letters, ord(m)].any())
        wide = "".join(m for m in marks if not self.pairs[0x80:0xC0, ord(m)].any())
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast_marks = bool(marks) and not any(t[:1].isalnum() or t[:1] in MARKS for t in added)
        marks, wide = re.escape(marks), re.escape(wide)
        if not self.fast_marks:
            self.fast = re.compile(r"\s*\S+|\s+")
        else:
            letters = rf"[^\W\d_]*(?:[{STEADY}](?=[\s{wide}]|\Z)|[A-Za-z](?=[{marks}]))"
            # Most words, found without going back; what is not one of them is left to the rest.
            common = rf"[ \n]?+[{STEADY}]++(?:(?=[ \n{wide}])|(?<=[A-Za-z])(?=[{marks}]))"
            self.fast = re.compile(rf"{common}|\s*{letters}|\s*\S+|\s+")
        self.drops_white = self._drops_white()
        # A mark after a letter, for vocabularies that drop white space. Marks are the rarer ones.
        self.joints = re.compile(rf"[{marks}](?<=[A-Za-z][{marks}])") if self.fast_marks else None
        # Bytes of each token, where these add up to the text and white space parts it.
        self.widths = np.array([len(t) for t in raw]) if self.inner and self.plain else None
        self.closes = self.word_ends() if self.widths is None else None
        # The fragments that may be encoded as one text.
        self.together = None
        if self.widths is not None or self.closes is not None:
            self.together = (SPACED_WORD if self.closes is None else LATIN_WORD).fullmatch
        # What was met lately, and before that; what is met again moves to the first.
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def fragments(self, text: str) -> list[str]:
        """The pieces between forced boundaries; joined they are the text."""
        if self.plain and not OTHER_WHITE.search(text):
            return self.fast.findall(text)
        return [f for f in self.cuts.split(text) if f]

    def _drops_white(self) -> bool:
        """Whether white space gives no ids and only parts what it stands between."""

        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        between = [(a, w, b) for w in (*WHITE, "  ", " \n ") for a, b in ("ab", "..", ("1", "'s"))]
        return not ids(WHITE) and all(ids(a + w + b) == ids(a) + ids(b) for a, w, b in between)

    def pieces(self, text: str) -> list[str]:
        """What is encoded of a text: its fragments, without white space where that is dropped."""
        if not self.drops_white or not self.plain or OTHER_WHITE.search(text):
            return self.fragments(text)
        return (self.joints.sub(r" \g<0>", text) if self.joints else text).split()

    def cut_inside(self, fragment: str) -> list[str]:
        """A fragment between all pairs of bytes that no token holds; its parts joined are the
        fragment."""
        data = fragment.encode()
        held = np.frombuffer(data, np.uint8)
        left, right = held[:-1], held[1:]
        apart = ~self.pairs[left, right] & ((right & 0xC0) != 0x80) & (right != 0x27)
        white = len(fragment) - len(fragment.lstrip())  # ASCII, stays with what follows
        places = (np.flatnonzero(apart[white:]) + white + 1).tolist()
        return [data[a:b].decode() for a, b in zip([0, *places], [*places, len(data)])]

    def word_ends(self) -> np.ndarray | None:
        """Whether a token ends a word, for vocabularies that mark it and drop white space, if every
        word of Latin letters has one such token."""
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        if not suffix or not self.drops_white or not self.plain:
            return None
        closes = np.array([t.endswith(suffix) for t in self.tokens])
        letters = "abcdefghijklmnopqrstuvwxyz"
        tried = [*letters, *letters.upper(), "aB", "Ab", "aBa", "AB", letters, letters.upper()]
        coded = self.tokenizer.encode_batch_fast(tried, add_special_tokens=False)
        one = all(c.ids and closes[c.ids].sum() == 1 and closes[c.ids[-1]] for c in coded)
        return closes if one else None

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of words that ``together`` matches, many encoded as one text.

        That text has a forced boundary at each of them. The bytes of its tokens or the tokens that
        end a word tell where; nothing is returned if they do not agree with the words.
        """
        glue = "" if self.widths is not None else " "
        texts = [glue.join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([c.ids for c in coded]), "<u4")
        if self.widths is None:
            last = np.flatnonzero(self.closes[ids])
            if len(last) != len(words) or last[-1] != len(ids) - 1:
                return []
        else:
            widths = self.widths[ids]
            ends = np.cumsum(widths)
            wanted = np.cumsum([len(w.encode()) for w in words])
            if not len(ids) or ends[-1] != wanted[-1] or not widths.all():
                return []
            last = np.searchsorted(ends, wanted)
            if (ends[last] != wanted).any():
                return []
        data, stops = ids.tobytes(), (4 * (last + 1)).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED // 2:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        split = [self.pieces(t) for t in texts]
        missing = set().union(*split).difference(known)
        again = missing.intersection(earlier)
        known.update((f, earlier.pop(f)) for f in again)
        missing = list(missing - again)
        long = [f for f in missing if len(f) > LONG_CHARS] if self.inner else []
        long = {f: self.cut_inside(f) for f in long if not OTHER_WHITE.search(f)}
        if long:
            parts = set().union(*long.values()).difference(known)
            missing = list(parts.union(f for f in missing if f not in long))
        words = list(filter(self.together, missing)) if self.together else []
        ids = self.encode_words(words) if words else []
        known.update(zip(words, ids))
        apart = list(set(missing).difference(words)) if ids else missing
        coded = self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)
        known.update((f, array("I", c.ids).tobytes()) for f, c in zip(apart, coded))
        find = known.__getitem__
        known.update((f, b"".join(map(find, parts))) for f, parts in long.items())
        made = [b"".join(map(find, fragments)) for fragments in split]
        for f in (*missing, *long):
            if len(f) > REMEMBERED_CHARS:
                known.pop(f, None)
        return made

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens kept, for a vocabulary without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def codec_of(vocabulary: str) -> FragmentCodec:
    """The codec of a vocabulary, kept by the worker over its tasks."""
    kept = sys.modules.setdefault("lexiform_worker_codecs", types.ModuleType("codecs")).__dict__
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in kept:
        kept.clear()
        kept[key] = FragmentCodec(vocabulary)
    return kept[key]


def shared_vocabulary(df: DataFrame, path: str):
    """The vocabulary file, read by the driver and sent to the tasks; its size is checked."""
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key and the ids of its whole text: (key, ids binary, decoded string).

    ``ids`` holds little-endian unsigned 32-bit integers. ``decoded`` is the text of these ids as
    the tokenizer decodes them, special tokens kept. One output row per input row, repeated rows
    and null keys included; other columns, whatever their names, are not read.
    """
    vocabulary = shared_vocabulary(docs, path)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = StructType(
        [
            StructField("key", rows.schema["key"].dataType),
            StructField("ids", BinaryType()),
            StructField("decoded", StringType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary.value)
        for part, texts in chunks_of_text(batches):
            ids = codec.encode(texts)
            yield record_batch(
                schema,
                {"key": part.column("key"), "ids": ids, "decoded": list(map(codec.decode, ids))},
            )

    return rows.mapInArrow(encode, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the decoded text."""
    coded = encode_texts(docs, path, key)
    return coded.select(
        F.col("key").alias(key),
        (F.octet_length("ids") / 4).cast(LongType()).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
