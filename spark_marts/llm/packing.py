"""Sum-of-squares online packing of token sequences.

A document's full windows of ``LENGTH`` ids are cut off as sequences of their own. What remains goes,
uncut, to the fill level that makes the sum over levels of (number of windows filled to that level)
squared smallest, the counts being kept in one array by level. At the end of a task (or when
``MOST_OPEN`` windows are open) the open windows are emptied into full sequences, cutting where needed,
and the rest of under ``LENGTH`` ids is cut into sequences of powers of two, which need no padding.

A Spark partition is packed by itself, so nothing is shuffled and sequence ids carry the partition
number in their upper bits. Tokens come word by word from a bounded memory: the tokenizer never
joins ids across the white space that ``[\\x20\\x09-\\x0D]`` stands for.

Defined cases: null or empty text is the one closing id; repeated rows are packed as often as they
occur; a null doc_id is passed on; other columns are ignored; an empty table packs to nothing.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import SLICE_ROWS, arrow_schema, kept, table, texts_of

LENGTH = 2048
END = np.array([1], "<u4").tobytes()
MOST_OPEN = 4096
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


class Remembered(dict):
    """Results of ``make(key)``; when ``most`` keys are young they become the old ones, and the old ones go."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        out = self[key] = self.old[key] if key in self.old else self.make(key)
        return out


class Tokens:
    """Packed ids (little-endian 32 bits) of texts, by way of remembered words and word parts.

    Plain Latin words are cut as the vocabulary's own pre-tokenizer cuts them and each part goes to the
    BPE model directly; any other word goes through the whole tokenizer. A tokenizer that does not cut
    so, by a probe, gets whole texts.
    """

    PROBE = "The quick  brown-fox's 12,345 DON'T <|x|> naïve\tÉté (a_b) §9 Straße... \n x!? 3rd we'LL ½µm 東京"

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: bytes that stand for themselves
        rest = iter(range(256, 512))
        self.letter = {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words, self.parts = Remembered(self.word, most), Remembered(self.part, most)
        self.by_word = self.joined(self.PROBE) == self.whole(self.PROBE)

    def part(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letter)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(spelled)])

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            text = text.lower()
            if text.isalpha():  # one part
                return self.parts[text]
            return b"".join([self.parts[p] for p in self.PART.findall(text)])
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.encode().split()))

    def of(self, text: str) -> bytes:
        return (self.joined(text) if self.by_word else self.whole(text)) + END


class Packer:
    """Places pieces ``(doc, start, ids, doc_tokens)``; ``done`` takes each finished sequence."""

    def __init__(self, done, length: int = LENGTH, most_open: int = MOST_OPEN):
        self.done, self.length, self.most_open = done, length, most_open
        self.counts = np.zeros(length + 1, np.int64)  # level array: windows filled to each level
        self.windows: list[list] = [[] for _ in range(length)]
        self.open = 0

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose use makes the sum of squares smallest; ties to the fullest."""
        n, top = self.counts, self.length - size
        after = 2 * n[size : self.length + 1] + 1  # what one more window at h + size adds, h = 0..top
        after[top] = 0  # a full window leaves the array
        change = after.copy()
        change[1:] += np.where(n[1 : top + 1] > 0, 1 - 2 * n[1 : top + 1], 1 << 40)
        return top - int(change[::-1].argmin())

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        full = total // self.length * self.length
        for at in range(0, full, self.length):
            self.done([(doc, at, ids[4 * at : 4 * (at + self.length)], total)])
        if full < total:
            self.place((doc, full, ids[4 * full :], total))

    def place(self, piece) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        window = [*self.windows[level].pop(), piece] if level else [piece]
        self.counts[level] -= bool(level)
        self.open += (not level) - (level + size == self.length)
        if level + size == self.length:
            self.done(window)
        else:
            self.windows[level + size].append(window)
            self.counts[level + size] += 1
        if self.open > self.most_open:
            self.drain(last=False)

    def drain(self, last: bool = True) -> None:
        """Empties the open windows into full sequences; what is left over closes in powers of two."""
        pieces = [p for level in reversed(self.windows) for w in level for p in w]
        self.windows, self.open = [[] for _ in range(self.length)], 0
        self.counts[:] = 0
        left = sum(len(p[2]) // 4 for p in pieces)
        sizes = [self.length] * (left // self.length) + [1 << b for b in range(self.length.bit_length(), -1, -1) if left % self.length >> b & 1]
        if not last and left % self.length:  # the rest waits in one window
            sizes = [*sizes[: left // self.length], left % self.length]
        pieces.reverse()
        for n, size in enumerate(sizes):
            window, room = [], size
            while room:
                doc, start, ids, total = pieces.pop()
                window.append((doc, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    pieces.append((doc, start + room, ids[4 * room :], total))
                room -= len(window[-1][2]) // 4
            if not last and n == len(sizes) - 1 and size < self.length:
                self.windows[size].append(window)
                self.counts[size], self.open = 1, 1
            else:
                self.done(window)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece; ``tokenizer`` is the vocabulary file's path on every executor."""
    schema = arrow_schema(DDL)

    def run(batches):
        tokens, rows, made = kept(Tokens, tokenizer), [], 0
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32

        def done(window):
            nonlocal made
            at, size = 0, sum(len(p[2]) for p in window) // 4
            for doc, start, ids, total in window:
                rows.append((doc, start, len(ids) // 4, crc32(ids), total, first + made, at, size))
                at += len(ids) // 4
            made += 1

        def flush():
            cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        packer = Packer(done, length)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packer.add(doc, tokens.of(text))
                yield flush()
        packer.drain()
        yield flush()

    return texts_of(docs).mapInArrow(run, DDL)


def op10_packing(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from public_tokenizers import path

    return pack(table(spark, sf_dir, "documents"), tokenizer or path("word_bpe_49k.json"))
