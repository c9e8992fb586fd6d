"""BPE encoding and decoding by a dynamic program over prefixes.

For every prefix of a word the encoding's LAST token is unique. It is found without any merging:
an automaton reports the tokens that end at the prefix, and the one that may stand after the last
token of the shorter prefix is kept. Following these links back from the whole word gives the ids.

Two tokens may stand next to each other if merging their joined letters would never merge across
the seam. Along the seam the left token shows its right-most parts and the right token its
left-most parts, each from its own merge until the merge that uses it up; a pair of parts that is
a merge of its own, and whose turn comes while both are there, crosses the seam.

Cases: a null text counts as empty; an empty text has no ids and decodes to empty text; texts and
words of any length are encoded whole; the special tokens' strings in a text become their ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


NEVER = 1 << 60
END = "</w>"
#: What the word cache and the seam cache hold at most before they start anew.
CACHE = 100_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves, the
    others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """The tokens of a tokenizer file as strings of symbols: a byte is code point b, a byte that
    ends a word is code point 256 + b. Ranks and parts come from the list of merges."""

    def __init__(self, raw: bytes):
        import ahocorasick

        spec = json.loads(raw)
        model, letters = spec["model"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        symbols: dict[int, str] = {}
        for b, letter in enumerate(letters):
            for token, symbol in ((letter, b), (letter + END, 256 + b)):
                if (i := model["vocab"].get(token)) is not None:
                    symbols[i] = chr(symbol)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = model["vocab"][left], model["vocab"][right]
            made = model["vocab"][left + right]
            self.pair[a, b] = rank
            self.rank[made], self.parts[made] = rank, (a, b)
            symbols[made] = symbols[a] + symbols[b]
        self.seams: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        usable: set[int] = set()
        for token in sorted(symbols, key=lambda t: self.rank.get(t, -1)):
            if token in self.parts:
                a, b = self.parts[token]
                if a not in usable or b not in usable or self._crosses(a, b, token):
                    continue  # merging never leaves this token
            usable.add(token)
            self.automaton.add_word(symbols[token], (token, len(symbols[token])))
        self.automaton.make_automaton()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts that lie at the seam, with the rank of the merge that uses each up."""
        out, until = [], NEVER
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            until, token = self.rank[token], self.parts[token][side]

    def _crosses(self, left: int, right: int, whole: int | None = None) -> bool:
        """True if a merge crosses the seam (other than the one that makes ``whole``). Of two
        equal merges the one further left comes first: the left token's own at a tie, but the
        seam's before the right token's own."""
        ends = self._spine(left, 1)
        for b, b_until in self._spine(right, 0):
            for a, a_until in ends:
                rank = self.pair.get((a, b))
                if rank is not None and rank < a_until and rank <= b_until:
                    if not (whole is not None and a == left and b == right):
                        return True
        return False

    def _judge(self, key: int) -> bool:
        """May the two tokens of the key stand next to each other? Kept for the next time."""
        if len(self.seams) >= 5 * CACHE:
            self.seams.clear()
        found = self.seams[key] = not self._crosses(key >> 32, key & 0xFFFFFFFF)
        return found

    def encode_word(self, word: str) -> list[int]:
        """The ids of one non-empty word."""
        data = word.encode("utf-8")
        n, seams = len(data), self.seams.get
        last, size = [-1] * n, [0] * n  # by the prefix's last symbol
        for end, (token, length) in self.automaton.iter(data[:-1].decode("latin-1") + chr(256 + data[-1])):
            if last[end] < 0:
                start = end - length
                if start >= 0:
                    key = last[start] << 32 | token
                    fits = seams(key)
                    if not (self._judge(key) if fits is None else fits):
                        continue
                last[end], size[end] = token, length
        at = n - 1
        ids = []
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids

    def decode(self, ids) -> str:
        """The tokens' strings, joined by single spaces (the file names no decoder)."""
        return " ".join(map(self.text.__getitem__, ids))


# Fixed value: the tokenizer file's own split pattern. No match of it holds white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts with other characters than these take the library's own normalizer and splitter: beyond
#: U+024F Python's Unicode tables may be of another version, and str.split() would part words at
#: the four separators U+001C to U+001F.
UNCOMMON = re.compile("[^\x00-\x1b\x20-\u024f]")


class _Words(dict):
    """word -> (the ids' decimal text, the tokens' text), filled as words are asked for. When it
    is full, its words become the older half, from which words in use return."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, word: str) -> tuple[str, str]:
        made = self.older.get(word)
        if made is None:
            special = self.vocabulary.special.get(word)
            ids = self.vocabulary.encode_word(word) if special is None else [special]
            made = (" ".join(map(str, ids)), self.vocabulary.decode(ids))
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[word] = made
        return made


class Encoder:
    """Encodes whole texts; one per Python worker."""

    def __init__(self, raw: bytes):
        import regex
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(raw)
        self.words = _Words(self.vocabulary)
        self.split = regex.compile(SPLIT).findall
        self.marks = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")") if self.vocabulary.special else None
        library = Tokenizer.from_str(raw.decode("utf-8"))
        self.normalizer, self.pre = library.normalizer, library.pre_tokenizer
        self.unletter = {c: b for b, c in enumerate(byte_letters())}

    def _plain(self, text: str) -> list[str]:
        if UNCOMMON.search(text):  # rare scripts: the library's own Unicode tables
            text = self.normalizer.normalize_str(text)
            return [bytes(map(self.unletter.__getitem__, piece)).decode("utf-8")
                    for piece, _ in self.pre.pre_tokenize_str(text)]
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        out: list[str] = []
        for chunk in text.lower().split():
            if chunk.isalpha():
                out.append(chunk)
            elif chunk[:-1].isalpha():  # letters and one other character
                out += (chunk[:-1], chunk[-1])
            else:
                out += self.split(chunk)
        return out

    def pieces(self, text: str) -> list[str]:
        """The words that are encoded one by one, special tokens among them."""
        if self.marks is None or "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for part in self.marks.split(text):
            if part in self.vocabulary.special:
                out.append(part)
            elif part:
                out += self._plain(part)
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids as decimal text, the decoded text."""
        pieces = self.pieces(text)
        if not pieces:
            return 0, "", ""
        numbers, back = map(" ".join, zip(*map(self.words.__getitem__, pieces)))
        return numbers.count(" ") + 1, numbers, back

    def ids(self, text: str) -> list[int]:
        return list(map(int, self.digest(text)[1].split()))


_ENCODERS: dict[int, Encoder] = {}


def encoder(raw: bytes) -> Encoder:
    """The worker's encoder; built once."""
    key = hash(raw)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(raw)
    return _ENCODERS[key]


def read_file(path: str) -> bytes:
    """A tokenizer file, read on the driver; it is sent to the workers (1 to 3 MB, by the vocabulary's size)."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           with_ids: bool = True) -> DataFrame:
    """``key, n_tokens, ids (array<int>), decoded, ids_sha256, decoded_sha256`` per row of ``docs``.

    No shuffle: each task encodes the rows it reads. ``with_ids=False`` leaves ``ids`` and
    ``decoded`` out (digests only). Extra columns of ``docs`` are not read. Repeated rows and null
    keys are encoded like any other.
    """
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(read_file(tokenizer))
    kind = docs.schema[key].dataType
    shape = f"k {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        shape += ", ids array<int>, decoded string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(raw.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what Python holds of long texts
                part = batch.slice(at, 256)
                n, a, b, ids, decoded = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    count, numbers, back = enc.digest(t or "")
                    n.append(count)
                    a.append(hashlib.sha256(numbers.encode()).hexdigest())
                    b.append(hashlib.sha256(back.encode()).hexdigest())
                    if with_ids:
                        ids.append(list(map(int, numbers.split())))
                        decoded.append(back)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                names = ["k", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(work, shape)
    return out.withColumnRenamed("k", key)


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded`` from arrays of ids; a null array decodes to empty text."""
    raw = encoded.sparkSession.sparkContext.broadcast(read_file(tokenizer))
    kind = encoded.schema[key].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(raw.value).vocabulary
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [vocabulary.decode(i or []) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["k", "decoded"])

    out = encoded.select(F.col(key).alias("k"), F.col(ids).alias("i")).mapInArrow(
        work, f"k {kind.simpleString()}, decoded string")
    return out.withColumnRenamed("k", key)
