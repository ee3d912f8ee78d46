"""Personal data: base patterns, and a character-level BiLSTM-CRF that adds what is written otherwise.

The tagger is trained on windows of the corpus whose base spans are the labels, some of them rewritten
as people write to avoid patterns (a plus left out, ``(AT)`` or a word for the sign, ``[.]`` or a word
for dots, dots between digit groups).  Digits of other scripts and wide forms count as the ASCII ones.

Overlapping windows lie on one grid over the whole text.  The windows' marginals are averaged, weighted
to their middle, and one Viterbi pass decides, so spans across window borders come out once.  No span
is valid without a digit or a sign for "at" (``valid``), so the windows are run from the blocks that hold
one outwards, as far as the tagger sees anything: until a whole block is outside at each of its places.
What lies beyond cannot hold a span, so the result is that of all windows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from layerhouse.llm import tagger
from layerhouse.llm.inputs import slices

#: Kinds in their order.
KINDS = ("email", "ip", "card", "phone")

#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)

#: Characters of a window, and from one window to the next.
WIDTH, STRIDE = 64, 32

#: Most windows the tagger is trained on: different ones, chosen by a hash of their text.
WINDOWS = 3_000

#: Mean probability from which a tagged span is added.
SURE = 0.9

# The base patterns (fixed values); the look-behind only keeps a search from restarting inside digits.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Words for the sign and for a dot (fixed values): English, German, Spanish, French.
AT_WORDS, DOT_WORDS = "at|ät|arroba|arobase", "dot|punkt|punto|point"

#: What every valid span holds, however it is written; texts are folded before.
SIGN = re.compile(rf"[0-9@]|(?<![^\W_])(?:{AT_WORDS})(?![^\W_])", re.IGNORECASE)
AT = re.compile(rf"\s*[\[({{<]\s*(?:@|{AT_WORDS})\s*[\])}}>]\s*", re.IGNORECASE)
BARE_AT = re.compile(rf"(?:\s+|_)(?:{AT_WORDS})(?:\s+|_)", re.IGNORECASE)
DOT = re.compile(rf"\s*[\[({{<]\s*(?:\.|{DOT_WORDS})\s*[\])}}>]\s*|\s+(?:{DOT_WORDS})\s+", re.IGNORECASE)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SPELLED = re.compile(rf"(?<![^\W_])(?:({AT_WORDS})|{DOT_WORDS})(?![^\W_])", re.IGNORECASE)
BEYOND = re.compile("[\u0250-\U0010ffff]")
SIGN_CLASS, DOT_CLASS = tagger.classes("@.")
DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def _parts_ok(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


@lru_cache(maxsize=1)
def _folds() -> dict[int, str]:
    """Decimal digits of all scripts, and wide and small forms, with their ASCII character."""
    table = {c: str(d) for c in range(0x250, 0x110000) if (d := unicodedata.decimal(chr(c), None)) is not None}
    for c in (*range(0xFE50, 0xFE6C), *range(0xFF01, 0xFF5F)):
        if len(plain := unicodedata.normalize("NFKC", chr(c))) == 1 and plain.isascii():
            table[c] = plain
    return table


def folded(text: str) -> str:
    """The text in ASCII signs and digits, character by character: places stay."""
    return text.translate(_folds()) if not text.isascii() and BEYOND.search(text) else text


def coded(text: str) -> np.ndarray:
    """The classes of a folded text; a word for the sign or for a dot has that character's class throughout."""
    codes = tagger.classes(text)
    for m in SPELLED.finditer(text):
        codes[m.start():m.end()] = SIGN_CLASS if m[1] else DOT_CLASS
    return codes


def valid(kind: str, text: str) -> bool:
    """What a folded span of a kind must satisfy, judged by its plain form however it is written."""
    if kind == "email":
        text = DOT.sub(".", AT.sub("@", text))
        return text.count("@") == 1 or bool("@" not in text and EMAIL.fullmatch(BARE_AT.sub("@", text)))
    if kind == "ip":
        text = DOT.sub(".", text)
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text)) and _parts_ok(text)
    digits = _digits(text)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; a match needs the first sign after its start, so each sign is tried once."""
    end = 0
    at = text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (domain := DOMAIN.match(text, at + 1)):
                end = domain.end()
                yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind, by start and then kind; failing ones are dropped."""
    found: list[Span] = [(s, e, "email") for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if _parts_ok(m[0]):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def trimmed(kind: str, text: str, start: int, end: int) -> tuple[int, int]:
    """A tagged span without what its kind cannot begin or end with."""
    edge = str.isalnum if kind == "email" else str.isdigit
    while start < end and not (edge(text[start]) or (kind == "phone" and text[start] in "+(")):
        start += 1
    while start < end and not edge(text[end - 1]):
        end -= 1
    return start, end


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within half a window of a digit or a sign, joined where they meet."""
    out: list[tuple[int, int]] = []
    for m in SIGN.finditer(text):
        start, end = max(0, m.start() - WIDTH // 2), min(len(text), m.end() + WIDTH // 2)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def rewritten(text: str, kind: str, way: int) -> str:
    """A span as it is written to avoid patterns; ``way`` 0 leaves it alone."""
    if kind == "email" and way:
        sign, dot = ((" at ", "."), ("(at)", "."), ("[at]", "."), (" (at) ", "."), (" at ", " dot "), (" (AT) ", "."), ("[AT]", "[.]"),
                     (" AT ", " DOT "))[way % 8]
        local, domain = text.split("@", 1)
        return local + sign + domain.replace(".", dot)
    if kind == "ip" and way:
        return text.replace(".", ("[.]", "(.)", " dot ", "[dot]")[way % 4])
    if kind == "phone" and way:
        return (text.lstrip("+"), text.replace("+", "00", 1), re.sub(r"[ ()-]+", ".", text.lstrip("+")))[way % 3]
    if kind == "card" and way:
        digits = _digits(text)
        return (".", "/", "_")[way % 3].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return text


def lesson(text: str, spans: list[Span], start: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of one window from ``start``, its spans rewritten by ``salt``."""
    chars, tags, at = [], [], start
    for n, (s, e, kind) in enumerate(s for s in spans if s[0] >= start and s[0] < start + WIDTH):
        if s < at:
            continue
        chars.append(text[at:s])
        tags += [0] * (s - at)
        way = (salt >> (4 * (n % 16))) % 16
        own = rewritten(text[s:e], kind, max(0, way - 8))
        chars.append(own)
        place = 1 + 2 * KINDS.index(kind)
        tags += [place] + [place + 1] * (len(own) - 1)
        at = e
    rest = text[at:start + 2 * WIDTH]
    codes = coded("".join(chars) + rest)[:WIDTH]
    tags = (tags + [0] * len(rest))[:WIDTH]
    pad = WIDTH - len(codes)
    return np.pad(codes, (0, pad)), np.pad(np.array(tags, "i4"), (0, pad))


def learn(df: DataFrame, text_col: str = "text", windows: int = WINDOWS) -> tagger.Tagger | None:
    """Train on at most ``windows`` windows around digits and signs; None where there are none.

    Null texts are left out.  Equal windows count once, however many copies there are.  Each task hands on
    no more than ``windows`` different ones, and only the chosen ones come to the driver.
    """
    schema = T.StructType([T.StructField("order", T.LongType()), T.StructField("chars", T.BinaryType()),
                           T.StructField("tags", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, bytes], bytes] = {}
        last = 1 << 63  # beyond it a window cannot be among the first ones
        for _, batch in slices(batches):
            for text in batch:
                if text and SIGN.search(text := folded(text)):
                    spans = base_spans(text)
                    for start, end in stretches(text):
                        own = [s for s in spans if start <= s[0] < end]
                        for at in range(start, max(start + 1, end - STRIDE), STRIDE):
                            salt = xxhash.xxh3_64_intdigest(text[at:at + WIDTH])
                            if salt >> 1 > last or any(s < at < e for s, e, _ in own):
                                continue  # a window does not begin inside a span
                            chars, tags = lesson(text, own, at, salt)
                            key, value = (salt >> 1, chars.tobytes()), tags.astype("u1").tobytes()
                            kept[key] = min(value, kept.get(key, value))
                if len(kept) > 2 * windows:
                    kept = dict(sorted(kept.items())[:windows])
                    last = max(kept)[0]
        rows = [(order, chars, tags) for (order, chars), tags in sorted(kept.items())[:windows]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))],
            names=schema.names)

    told = df.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(cut, schema)
    rows = told.groupBy("order", "chars").agg(F.min("tags").alias("tags")).orderBy("order", "chars").limit(windows).collect()
    if not rows:
        return None
    chars = np.stack([np.frombuffer(r["chars"], "u1") for r in rows])
    tags = np.stack([np.frombuffer(r["tags"], "u1") for r in rows]).astype("i4")
    return tagger.train(chars, tags, TAGS)


def _allowed() -> np.ndarray:
    """Zero where a tag may follow another; inside follows begin or inside of its kind only."""
    allowed = np.zeros((TAGS, TAGS))
    for inside in range(2, TAGS, 2):
        allowed[:, inside] = -1e9
        allowed[[inside - 1, inside], inside] = 0
    return allowed


ALLOWED = _allowed()

#: Weight of a place within its window: the middle has seen the most on both sides.
MIDDLE = 1 + np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])[:, None].astype("f8")


def _cover(block: int, blocks: int) -> range:
    """The windows of the grid that see a block of a text; a window begins with the block of its number."""
    last = max(0, blocks - WIDTH // STRIDE)
    return range(min(last, max(0, block - WIDTH // STRIDE + 1)), min(last, block) + 1)


def tagged_spans(net: tagger.Tagger, batch: list[str], everywhere: bool = False) -> list[list[Span]]:
    """Spans of each text by overlapping windows, reconciled over each stretch of blocks.

    ``everywhere`` runs every window, which gives the same spans.
    """
    texts = [folded(t) for t in batch]
    number = [-(-len(t) // STRIDE) for t in texts]
    codes: dict[int, np.ndarray] = {}
    logs: dict[tuple[int, int], np.ndarray] = {}
    seen: set[tuple[int, int]] = set()
    wanted: set[tuple[int, int]] = set()
    fresh: set[tuple[int, int]] = set()
    for n, text in enumerate(texts):
        for place in range(number[n]) if everywhere else {p // STRIDE for m in SIGN.finditer(text) for p in (m.start(), m.end() - 1)}:
            fresh.update((n, b) for b in range(max(0, place - 1), min(number[n], place + 2)))
    while fresh:
        wanted |= fresh
        cuts = sorted({(n, w) for n, b in fresh for w in _cover(b, number[n])} - seen)
        seen.update(cuts)
        for first in range(0, len(cuts), 512):
            group = cuts[first:first + 512]
            chars = np.zeros((WIDTH, len(group)), "u1")
            for column, (n, w) in enumerate(group):
                if n not in codes:
                    codes[n] = coded(texts[n])
                own = codes[n][w * STRIDE:w * STRIDE + WIDTH]
                chars[:len(own), column] = own
            sure = tagger.log_marginals(net, chars) * MIDDLE[:, :, None]
            for column, (n, w) in enumerate(group):
                for k in range(WIDTH // STRIDE):
                    part = sure[k * STRIDE:(k + 1) * STRIDE, column]
                    if (n, w + k) in logs:
                        logs[n, w + k] += part
                    elif w + k < number[n]:
                        logs[n, w + k] = part.copy()
        near = set()
        for n, b in fresh:
            share = sum(MIDDLE[(b - w) * STRIDE:(b - w + 1) * STRIDE] for w in _cover(b, number[n]))
            own = logs[n, b][:len(texts[n]) - b * STRIDE]
            own /= share[:len(own)]
            if (own[:, 0] <= np.log(0.5)).any():
                near.update((n, c) for c in (b - 1, b + 1) if 0 <= c < number[n])
        fresh = near - wanted
    out: list[list[Span]] = [[] for _ in batch]
    if not wanted:
        return out  # no text holds a digit or a sign
    order = sorted(wanted)
    starts = [k for k, (n, b) in enumerate(order) if not k or order[k - 1] != (n, b - 1)]
    for k, until in zip(starts, [*starts[1:], len(order)], strict=True):
        n, start = order[k][0], order[k][1] * STRIDE
        own = np.concatenate([logs[key] for key in order[k:until]])[:len(texts[n]) - start]
        if (own[:, 0] > np.log(0.5)).all():
            continue
        path = tagger.best_path(own, ALLOWED)
        at = 0
        while at < len(path):
            if path[at] % 2 == 0:
                at += 1
                continue
            end = at + 1
            while end < len(path) and path[end] == path[at] + 1:
                end += 1
            kind = KINDS[path[at] // 2]
            sure = np.exp(own[np.arange(at, end), path[at:end]]).mean()
            first, last = trimmed(kind, texts[n], start + at, start + end)
            if sure >= SURE and first < last and valid(kind, texts[n][first:last]):
                out[n].append((first, last, kind))
            at = end
    return out


def all_spans(net: tagger.Tagger | None, batch: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text; an added span meets no base span."""
    given = [t or "" for t in batch]
    base = [base_spans(t) for t in given]
    added = tagged_spans(net, given) if net else [[] for _ in given]
    out = []
    for own, more in zip(base, added, strict=True):
        extra = [s for s in more if all(s[1] <= b[0] or b[1] <= s[0] for b in own)]
        out.append((own, sorted(own + extra, key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find(df: DataFrame, net: tagger.Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans`` for every row: arrays of (kind, start, end) in code points, end exclusive.

    ``spans`` has the base spans and those the tagger adds.  A null text has none.  Repeated rows repeat
    their result, an empty table gives an empty one, other columns are not read.
    """
    df = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([df.schema["doc_id"], T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in slices(batches):
            both = all_spans(net, batch)
            lists = [[[{"kind": k, "start": s, "end": e} for s, e, k in spans[which]] for spans in both] for which in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, kind) for x in lists)], names=schema.names)

    return df.mapInArrow(run, schema)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one of the first kind."""
    out, at = [], 0
    for n, (start, end, kind) in enumerate(spans):
        if n and start < at:
            at = max(at, end)
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(df: DataFrame, net: tagger.Tagger | None, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df``, with personal data in ``text_col`` masked.

    A null text stays null and an empty one empty; repeated rows repeat their result, an empty table gives an
    empty one, and other columns are passed on whatever their names.
    """
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in slices(batches, text_col):
            masked = [t if t is None else mask(t, spans) for t, (_, spans) in zip(batch, all_spans(net, batch), strict=True)]
            yield part.set_column(place, part.schema.field(place), pa.array(masked, part.schema.field(place).type))

    return df.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, df.schema)
