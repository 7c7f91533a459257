"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

A vocabulary file gives the merge list. Reading a unit from left to right, a
token is final as soon as no text that may follow can still change it. How far
that is follows from the merge list alone (``lookahead``): where two texts
agree up to some place, their segmentations can only differ from a front on
that starts there. The rule ``u + v`` moves the front left by ``u`` at most
once, and only if ``v`` may start at the front with one text and not with the
other. What starts at a front left by ``u'`` begins with the token ``u'``
unmerged, so ``v`` has ``u'`` on its left spine and the rule comes later in the
list. The longest such chain, measured in symbols, is a sufficient lookahead.

The transducer holds one window: the lookahead and one token at least. It merges
the window, emits the tokens that end before the lookahead, and goes on behind
the last of them. No merge goes over an emitted boundary, so what follows is
encoded as if it stood alone. State is bounded by the merge list, whatever the
length of a unit. Texts are split into units first, at white space and where
the letters, digits and other signs meet, as the file's splitter does.

Decoding is incremental as well: the bytes of each token pass a UTF-8 state
machine that keeps at most one unfinished character.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from feedmill.llm.common import slices, small_batches, unwrap, wrap

#: Fixed values of the vocabulary format: the mark of a word's last symbol, white space, and the splitter's pattern.
END = "</w>"
BLANK = "\t\n\u000b\u000c\r \u0085   -     　"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks of at most so many characters are remembered, at most twice so many of them.
REMEMBERED, MOST = 48, 200_000
#: Ids and ranks share a number, ids in so many bits. Lists of at most SHORT symbols are searched, longer ones keep a heap.
BITS, SHORT = 20, 64
MASK, NONE = (1 << BITS) - 1, 1 << 62
#: Tokens that the decoder takes at a time.
BLOCK = 4096

_BLANKS = regex.compile(f"[{BLANK}]+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")  # blank to str.split alone
_UNIT = regex.compile(SPLIT.replace(r"\s", BLANK))


def byte_signs() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(others)) for b in range(256)]


def lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Symbols behind a place that decide all merges before it; 1 more for the end mark.

    Raises ValueError if a rule uses a token that no earlier rule makes or two
    rules make the same token: then merging rule by rule is not what the list
    means, and the bound does not hold.
    """
    width = lambda token: len(token.removesuffix(END))
    left: dict[str, str] = {}
    moved: dict[str, int] = {}
    most = 0
    for u, v in merges:
        if u + v in left or any(width(t) != 1 and t not in left for t in (u, v)):
            raise ValueError(f"the rule {u!r} + {v!r} is out of order")
        spine, before = v, 0
        while True:
            before = max(before, moved.get(spine, 0))
            if spine not in left:
                break
            spine = left[spine]
        left[u + v] = u
        moved[u] = max(moved.get(u, 0), width(u) + before)
        most = max(most, moved[u])
    return most + 1


@dataclass
class Model:
    """The merge list of a vocabulary file; bounded by the file."""

    tokens: list[str]  # surface form of each id
    rules: dict[int, int]  # left id and right id: rank and id that it makes
    first: list[int]  # ids of the bytes
    last: list[int]  # ids of the bytes that end a unit
    special: dict[str, int]
    lookahead: int
    longest: int
    widths: list[int] = field(default_factory=list)  # symbols of each id
    surfaces: list[bytes] = field(default_factory=list)
    octets: list[bytes] = field(default_factory=list)

    def __post_init__(self) -> None:
        byte_of = {c: b for b, c in enumerate(byte_signs())}
        special = set(self.special.values())
        for i, token in enumerate(self.tokens):
            self.surfaces.append(token.encode())
            self.widths.append(len(token.removesuffix(END)))
            if i in special:
                self.octets.append(token.encode())
            else:
                whole = bytes(byte_of[c] for c in token.removesuffix(END))
                self.octets.append(whole + b" " * token.endswith(END))

        names = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None


def load(path: str) -> Model:
    """Read a ``tokenizers`` file. Raises ValueError where it asks for other steps than these."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    bpe = spec["model"]
    odd = [bpe.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")]
    if (
        steps != ["NFC", "Replace", "Lowercase"]
        or [p["type"] for p in parts] != ["Split", "ByteLevel"]
        or parts[0]["pattern"].get("Regex") != SPLIT
        or bpe["type"] != "BPE"
        or bpe["end_of_word_suffix"] != END
        or any(odd)
        or spec["decoder"]
    ):
        raise ValueError("only word-ended BPE behind NFC, blanks, lower case and the usual splitter is supported")
    ids = bpe["vocab"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in bpe["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if max([*ids.values(), *special.values()]) > MASK:
        raise ValueError("ids below 2^20 are expected")
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in (*ids.items(), *special.items()):
        tokens[i] = token
    signs = byte_signs()
    return Model(
        tokens,
        {ids[u] << BITS | ids[v]: rank << BITS | ids[u + v] for rank, (u, v) in enumerate(merges)},
        [ids[c] for c in signs],
        [ids[c + END] for c in signs],
        special,
        lookahead(merges),
        max(len(t.removesuffix(END)) for t in ids),
    )


def merged(token: list[int], model: Model) -> list[int]:
    """The tokens that all merges leave, best rank first, leftmost first among equals. Uses up ``token``."""
    rules, n = model.rules, len(token)
    if n <= SHORT:
        # A rule is its rank and the id it makes in one number, so equal numbers are one rule.
        found = [rules.get(u << BITS | v, NONE) for u, v in zip(token, token[1:])]
        while found:
            best = min(found)
            if best == NONE:
                break
            i = found.index(best)
            made = token[i] = best & MASK
            del token[i + 1], found[i]
            if i:
                found[i - 1] = rules.get(token[i - 1] << BITS | made, NONE)
            if i < len(found):
                found[i] = rules.get(made << BITS | token[i + 1], NONE)
        return token
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rule = rules.get(token[i] << BITS | token[i + 1])
        if rule is not None:
            heap.append((rule, i, token[i], token[i + 1]))
    heapq.heapify(heap)
    while heap:
        rule, i, u, v = heapq.heappop(heap)
        j = after[i]
        # Stale if one of the two has been merged since.
        if token[i] != u or j >= n or token[j] != v:
            continue
        token[i], token[j] = rule & MASK, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n:
                rule = rules.get(token[a] << BITS | token[b])
                if rule is not None:
                    heapq.heappush(heap, (rule, a, token[a], token[b]))
    return [t for t in token if t >= 0]


class Transducer:
    """Encodes one unit after the other, symbols in, stable tokens out.

    ``feed`` takes the next bytes of a unit and ``close`` its end. At most
    ``window`` symbols are held between calls.
    """

    def __init__(self, model: Model, lookahead: int | None = None):
        self.model = model
        self.ahead = model.lookahead if lookahead is None else lookahead
        # A token at least must fit before the lookahead; more of them save merging symbols twice.
        self.window = 3 * self.ahead + 2 * model.longest
        self.held: list[int] = []
        self.late = -1

    def feed(self, data: bytes) -> list[int]:
        """Tokens that are stable now."""
        out: list[int] = []
        first = self.model.first
        for at in range(0, len(data), self.window):
            part = data[at : at + self.window]
            # The last byte waits, as it may be the one that ends the unit.
            if self.late >= 0:
                self.held.append(first[self.late])
            self.held += [first[b] for b in part[:-1]]
            self.late = part[-1]
            while len(self.held) >= self.window:
                out += self._emit()
        return out

    def unit(self, data: bytes) -> list[int]:
        """The tokens of a whole unit; one that fits the window is merged at once."""
        if len(data) > self.window:
            return self.feed(data) + self.close()
        symbols = list(map(self.model.first.__getitem__, data))
        symbols[-1] = self.model.last[data[-1]]
        return merged(symbols, self.model)

    def _emit(self) -> list[int]:
        """The tokens of the window that end before the lookahead."""
        out, end, widths = [], 0, self.model.widths
        for token in merged(self.held[: self.window], self.model):
            if end + widths[token] > self.window - self.ahead:
                break
            out.append(token)
            end += widths[token]
        if not end:
            raise RuntimeError("the window holds no stable token")
        del self.held[:end]
        return out

    def close(self) -> list[int]:
        """The rest of the unit's tokens; the next ``feed`` begins a new unit."""
        if self.late < 0:
            return []
        symbols = [*self.held, self.model.last[self.late]]
        self.held, self.late = [], -1
        return merged(symbols, self.model)


def chunks(text: str) -> list[str]:
    """The parts between blanks, after NFC and lower case sign by sign."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    # A final sigma is a matter of whole words, which a sign-by-sign rule does not know.
    text = text.replace("Σ", "σ").lower()
    return _BLANKS.split(text) if _SEPARATORS.search(text) else text.split()


class Encoder:
    """Texts to packed ids. Remembers the ids of short chunks, the lately used ones at least, up to a bound."""

    def __init__(self, model: Model, most: int = MOST):
        self.model, self.steps, self.most = model, Transducer(model), most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, part: str) -> bytes | None:
        ids = self.young.get(part)
        if ids is None and part in self.old:
            ids = self._keep(part, self.old[part])
        return ids

    def _keep(self, part: str, ids: bytes) -> bytes:
        if len(part) <= REMEMBERED:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[part] = ids
        return ids

    def _unit(self, unit: str) -> bytes:
        ids = self._known(unit)
        return ids if ids is not None else self._keep(unit, array("I", self.steps.unit(unit.encode())).tobytes())

    def chunk(self, chunk: str) -> bytes:
        """Ids of a text without blanks."""
        ids = self._known(chunk)
        return ids if ids is not None else self._keep(chunk, b"".join([self._unit(u) for u in _UNIT.findall(chunk)]))

    def encode(self, text: str | None) -> bytes:
        """Ids, four bytes each; none for a null or blank text."""
        if not text:
            return b""
        marks = self.model.marks if "<" in text else None
        out = []
        for part in marks.split(text) if marks else (text,):
            if part in self.model.special:
                out.append(array("I", [self.model.special[part]]).tobytes())
            else:
                young = self.young
                for chunk in chunks(part):
                    out.append(young.get(chunk) or self.chunk(chunk))
                    young = self.young
        return b"".join(out)


class Decoder:
    """Ids in, text out, with at most one unfinished character between calls.

    ``surface`` writes the tokens as the file has them, with spaces between, as
    its library does without a decoder step. ``text`` writes the bytes they
    stand for, an end mark as a space; bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self, model: Model, form: str = "surface"):
        self.parts = {"surface": model.surfaces, "text": model.octets}[form]
        self.between = b" " if form == "surface" else b""
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        data = self.between.join([self.parts[i] for i in ids])
        if self.begun and data:
            data = self.between + data
        self.begun = self.begun or bool(data)
        return self.machine.decode(data)

    def close(self) -> str:
        self.begun = False
        rest = self.machine.decode(b"", True)
        self.machine.reset()
        return rest


def decode_ids(ids: list[int], model: Model, form: str = "surface") -> str:
    steps = Decoder(model, form)
    return "".join([*(steps.feed(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)), steps.close()])


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = True, form: str = "surface") -> DataFrame:
    """``docs`` plus ``_ids`` (array), ``_packed`` (the ids as little-endian bytes) and ``_decoded``.

    Null and blank texts have no ids and decode to an empty text. Special
    tokens written in a text are taken as such. Rows are encoded where they
    lie, without a shuffle; repeated rows stay repeated.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        encoder = Encoder(model)
        for batch in slices(batches, 256):
            packed = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            values = np.frombuffer(b"".join(packed), "<i4")
            sizes = np.cumsum([0, *(len(p) // 4 for p in packed)])
            back = [decode_ids(values[a:b].tolist(), model, form) if decoded else None for a, b in zip(sizes, sizes[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int32())),
                    pa.array(packed, pa.binary()), pa.array(back, pa.string()),
                ],
                names=["_doc", "_ids", "_packed", "_decoded"],
            )

    rows = wrap(docs, _text=F.col(text).cast("string"))
    made = [StructField("_ids", ArrayType(IntegerType())), StructField("_packed", BinaryType()), StructField("_decoded", StringType())]
    done = rows.mapInArrow(run, StructType([rows.schema["_doc"], *made]))
    return unwrap(done, docs.columns, "_ids", "_packed", "_decoded")


def decode(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded", form: str = "text") -> DataFrame:
    """``rows`` plus the text of its ``ids`` column; null ids decode to null."""
    model = load(path)

    @F.pandas_udf(StringType())
    def run(column):
        return column.map(lambda x: None if x is None else decode_ids(list(x), model, form))

    return rows.withColumn(name, run(F.col(ids)))
