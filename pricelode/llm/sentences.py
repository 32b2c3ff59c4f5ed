"""Sentence boundaries across languages and scripts, by a maximum-entropy classifier of candidate boundaries."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelode.llm.tokens import spread
from pricelode.session import checkpointed

# Marks that may end a sentence, marks that begin a line of its own, and what opens and closes a quotation or bracket.
END_MARKS = ".!?…。！？।॥؟۔"
BULLETS = "•–-*"
PAIRS = {"„": "“”", "“": "”", "«": "»", "»": "«", "‚": "‘", "「": "」", "『": "』", '"': '"', "(": ")", "（": "）", "[": "]"}
CLOSERS = "".join(sorted(set("".join(PAIRS.values())) | set("'’")))

#: The classifier is fitted on at most so many distinct contexts with a reliable label, and has so many hashed weights.
SAMPLE = 150_000
WEIGHTS = 1 << 18
#: Distinct contexts that a task counts together before it passes them on.
HELD = 100_000
#: A token counts as standing before marks, or before another token, when so many other characters at most lie between.
REACH = 40
#: Occurrences from which a token that never stands at a block's end (start) is taken for one that never ends (starts) a sentence.
ENOUGH = 20

_LINE = regex.compile(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]")
_BREAKS = "\n\r\x0b\x0c\x85\u2028\u2029"
_MARKS = regex.compile(rf"[{regex.escape(END_MARKS)}]+(?:[ \xa0]?[…!?]+)?|(?<=[\p{{Greek}}\p{{M}}»\)])[;\u037e]")
_TOKEN_BEFORE = regex.compile(r"(?r)[\p{L}\p{M}\p{N}\u200d]+")
_LAST_LETTER = regex.compile(r"(?r)[\p{L}\p{M}\p{N}\u200d]")
_TOKEN_AFTER = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_THAI = regex.compile(r"(?<=[ก-ฺเ-๎])\s+(?=[ก-ฺเ-๎])")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_ROMAN = regex.compile(r"[ivx]+")
_OPENERS = re.compile(f"[{re.escape(''.join(PAIRS))}]")
_BOUNDS = {opener: re.compile(f"[{re.escape(opener + closing)}]") for opener, closing in PAIRS.items()}


class Context(NamedTuple):
    """What is known of a candidate boundary; equal contexts are one case for the classifier."""

    mark: str  # the end marks
    closed: str  # "", quote or bracket: what closes between the marks and the boundary
    space: str  # "", " " or a line break: what stands between
    before2: str  # the token before the last, with a point if one follows it directly
    before: str  # the last token before the marks, without case; numbers are <n>
    before_shape: str
    after: str  # the first token behind, without case
    after_shape: str
    after_next: str  # what follows that token
    opened: str  # an opening quote or bracket before it
    cased: str  # how the document is written: N as usual, U all capitals, L all small


class Block(NamedTuple):
    start: int
    end: int
    single: bool  # a line of its own, which is not split


def _remembered(of: Callable[[str], str]) -> Callable[[str], str]:
    """`of`, with the results of up to 100,000 tokens kept."""
    known: dict[str, str] = {}

    def found(token: str) -> str:
        out = known.get(token)
        if out is None:
            if len(known) >= 100_000:
                known.clear()
            out = known[token] = of(token)
        return out

    return found


def blocks(text: str) -> list[Block]:
    """Parts between blank lines and bullet lines, without the white space around them."""
    out: list[Block] = []
    start = end = -1
    at = 0

    def close() -> None:
        nonlocal start
        if start >= 0:
            out.append(Block(start, end, False))
        start = -1

    for m in [*_LINE.finditer(text), None]:
        stop = m.start() if m else len(text)
        line = text[at:stop]
        inner = line.strip()
        if not inner:
            close()
        else:
            a = at + len(line) - len(line.lstrip())
            b = a + len(inner)
            if inner[0] in BULLETS:
                close()
                out.append(Block(a, b, True))
            else:
                if start < 0:
                    start = a
                end = b
        at = m.end() if m else stop
    close()
    return out


def enclosed(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Outermost quotations and brackets of a block as (opening place, closing place); one that is never closed encloses nothing."""
    spans: list[tuple[int, int]] = []
    at = start
    while m := _OPENERS.search(text, at, end):
        at = m.start()
        opener = text[at]
        if opener == "»" and at > start and not text[at - 1].isspace() and text[at - 1] not in "(„":
            at += 1  # closes something that was not opened
            continue
        depth = 1
        for n in _BOUNDS[opener].finditer(text, at + 1, end):
            depth += 1 if n[0] == opener and opener not in PAIRS[opener] else -1
            if not depth:
                spans.append((at, n.start()))
                at = n.start()
                break
        at += 1
    return spans


@_remembered
def _shape(token: str) -> str:
    if not token:
        return "none"
    if token.isdigit():
        return "year" if len(token) == 4 and token[:2] in ("19", "20") else f"n{min(len(token), 3)}"
    if token[0].isdigit():
        return "mixed"
    first = token[0]
    if first.isupper():
        kind = "U" if len(token) == 1 else "A" if token.isupper() else "C"
    else:
        kind = "l" if first.islower() else "o"
    if _ROMAN.fullmatch(token.lower()) and first.isupper():
        kind += "r"
    return kind + str(min(len(token), 4))


@_remembered
def _name(token: str) -> str:
    if not token:
        return ""
    if token[0].isdigit():
        return "<n>" if token.isdigit() else "<m>"
    if _UNSPACED.match(token):
        return token[:2]
    folded = token.casefold()
    return folded if len(folded) <= 32 else f"{folded[:20]}~{zlib.crc32(folded.encode()):x}"


def _writing(text: str) -> str:
    upper = sum(map(str.isupper, text))
    lower = sum(map(str.islower, text))
    if upper + lower < 12:
        return "N"
    return "U" if upper > 0.85 * (upper + lower) else "L" if upper == 0 else "N"


def _token_before(text: str, at: int, floor: int, reach: int) -> regex.Match | None:
    """The whole token that ends last before `at`, however long it is, if it ends within `reach` characters."""
    last = _LAST_LETTER.search(text, max(floor, at - reach), at)
    return _TOKEN_BEFORE.match(text, floor, last.end()) if last else None


def _last_tokens(text: str, at: int, floor: int) -> tuple[str, str, str]:
    m = _token_before(text, at, floor, REACH)
    if not m:
        return "", "none", ""
    token, gap = m.group(), at - m.end()
    if _UNSPACED.match(token[-1:]):
        token = token[-2:]
    name = _name(token) if not gap else "/" + text[at - 1]
    shape = _shape(token) if not gap else "/" + _shape(token)
    n = _token_before(text, m.start(), floor, REACH)
    if not n:
        return name, shape, ""
    between = text[n.end():m.start()]
    return name, shape, _name(n.group()) + ("." if between[:1] == "." else "") + ("" if between[-1:].isspace() else "+")


def _first_token(text: str, at: int, end: int) -> tuple[str, str, str, str]:
    opened = ""
    while at < end and (text[at] in PAIRS or text[at] in "'‘"):
        opened = text[at]
        at += 1
    m = _TOKEN_AFTER.match(text, at, end)
    if not m:
        return "/" + text[at:at + 1], "other", "", opened
    token = m.group()
    follows = text[m.end():m.end() + 1] if m.end() < end else ""
    kind = "" if not follows else " " if follows.isspace() else follows if follows in ".,:;!?%-–'" else "x"
    if _UNSPACED.match(token):
        token = token[:2]
    return _name(token), _shape(token), kind, opened


def candidates(text: str, block: Block, cased: str, spans: list[tuple[int, int]]) -> Iterator[tuple[int, Context]]:
    """Places behind end marks (and what closes there) at which a sentence of the block may end, in order; `spans` are its quotations and brackets."""
    start, end = block.start, block.end
    k = 0
    for m in _MARKS.finditer(text, start, end):
        at = m.end()
        if at <= (spans[k - 1][1] if k else -1):
            continue
        while k < len(spans) and spans[k][1] < m.start():
            k += 1
        closed = ""
        if k < len(spans) and spans[k][0] < m.start() <= spans[k][1]:
            if at != spans[k][1] and not (at < spans[k][1] and not text[at:spans[k][1]].strip(CLOSERS)):
                continue  # inside; not its last marks
            closed = "bracket" if text[spans[k][0]] in "(（[" else "quote"
            at = spans[k][1] + 1
            k += 1
            if at < end and text[at] in END_MARKS:
                continue  # the marks behind it decide
        while at < end and text[at] in "'’":
            at += 1
        if at >= end:
            return
        to = at
        while to < end and text[to].isspace():
            to += 1
        if to >= end:
            return
        if text[to] in ",;:)]%،、，；：）" or text[to] in END_MARKS:
            continue
        gap = text[at:to]
        before, before_shape, before2 = _last_tokens(text, m.start(), start)
        after, after_shape, after_next, opened = _first_token(text, to, end)
        if m.group() == "." and not gap and text[m.start() - 1:m.start()].isdigit() and text[at].isdigit():
            continue  # a decimal
        mark = m.group().replace(" ", "").replace("\xa0", "")
        space = "" if not gap else "n" if any(c in _BREAKS for c in gap) else " "
        yield at, Context(mark[:3], closed, space, before2, before, before_shape, after, after_shape, after_next, opened, cased)


def ended(text: str, block: Block) -> Context | None:
    """The left side of a block's end, if it ends with end marks."""
    tail = text[max(block.start, block.end - 8):block.end]
    stripped = tail.rstrip(CLOSERS)
    m = regex.search(rf"[{regex.escape(END_MARKS)}]+$", stripped)
    if not m:
        return None
    stop = block.end - len(tail) + m.start()
    before, shape, before2 = _last_tokens(text, stop, block.start)
    closed = "" if len(tail) == len(stripped) else "quote" if tail[len(stripped)] not in ")）]" else "bracket"
    return Context(m.group()[:3], closed, " ", before2, before, shape, "", "", "", "", "")


def features(c: Context) -> list[str]:
    """Neighbouring tokens, case, length, digits and script, alone and together. Case counts only where the document uses it."""
    case = c.cased == "N"
    bs, fs = (c.before_shape, c.after_shape) if case else (c.before_shape.lower().replace("c", "a"), c.after_shape.lower().replace("c", "a"))
    place = f"{c.mark}|{c.closed}|{c.space}"
    return [
        f"b={c.before}|{c.mark[:1]}", f"a={c.after}", f"ba={c.before}|{c.after}", f"bf={c.before}|{fs[:1]}|{c.space}", f"sa={bs}|{c.after}", f"cc={c.before2}|{c.before}",
        f"p={place}|{fs[:1]}|{case}", f"s={bs}|{fs}|{c.space}|{case}", f"x={fs}|{c.after_next}", f"bx={bs}|{fs}|{c.after_next}", f"o={c.opened}|{c.mark[:1]}",
        f"d={c.before2}|{bs}|{fs[:1]}", f"pl={place}|{c.after}", f"n={c.after_next}|{c.after}",
    ]


def _hashed(contexts: list[Context]) -> np.ndarray:
    return np.array([[zlib.crc32(f.encode()) % WEIGHTS for f in features(c)] for c in contexts], np.int32).reshape(len(contexts), -1)


class Classifier:
    """Binary maximum entropy over hashed features."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[Context, bool] = {}

    def says(self, contexts: list[Context]) -> list[bool]:
        new = list({c for c in contexts if c not in self.known})
        if new:
            if len(self.known) > 300_000:
                self.known.clear()
                new = list(set(contexts))
            score = self.weights[_hashed(new)].sum(axis=1) + self.bias
            self.known.update(zip(new, (score > 0).tolist()))
        return [self.known[c] for c in contexts]

    @staticmethod
    def fit(rows: np.ndarray, labels: np.ndarray, counts: np.ndarray, passes: int = 12, rate: float = 0.3, decay: float = 1e-5) -> Classifier:
        """Adagrad on the weighted logistic loss of rows of hashed features, in batches of a fixed order."""
        weights, squares = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-6)
        bias = 0.0
        if not len(rows):
            return Classifier(weights.astype(np.float32), 0.0)
        importance = np.sqrt(counts)
        random = np.random.default_rng(7)
        for _ in range(passes):
            order = random.permutation(len(rows))
            for at in range(0, len(order), 2_000):
                part = order[at:at + 2_000]
                score = np.clip(weights[rows[part]].sum(axis=1) + bias, -30, 30)
                slope = (1 / (1 + np.exp(-score)) - labels[part]) * importance[part]
                own = np.bincount(rows[part].ravel(), np.repeat(slope, rows.shape[1]), WEIGHTS)
                at_ = np.unique(rows[part])
                step = own[at_] + decay * weights[at_]
                squares[at_] += step**2
                weights[at_] -= rate * step / np.sqrt(squares[at_])
                bias -= 0.001 * slope.mean()
        return Classifier(weights.astype(np.float32), float(bias))


class Atoms(NamedTuple):
    """The parts of a text between all places where a unit may end: their ends without white space, and what is known of each end."""

    starts: list[int]
    stops: list[int]
    ends: list[Context | None]  # None: a unit ends here in any case


def atoms(text: str, own_blocks: list[Block], cased: str) -> Atoms:
    """The atoms of a text, in order. Each block's last one ends a unit, and so do Thai spaces outside quotations."""
    starts: list[int] = []
    stops: list[int] = []
    ends: list[Context | None] = []
    for block in own_blocks:
        cuts: dict[int, Context | None] = {}
        if not block.single:
            spans = enclosed(text, block.start, block.end)
            cuts = dict(candidates(text, block, cased, spans))
            for m in _THAI.finditer(text, block.start, block.end):
                if not any(a < m.start() <= b for a, b in spans):
                    cuts[m.start()] = None
        start = block.start
        for cut in [*sorted(cuts), block.end]:
            while start < cut and text[start].isspace():
                start += 1
            stop = cut
            while stop > start and text[stop - 1].isspace():
                stop -= 1
            if stop > start:
                starts.append(start)
                stops.append(stop)
                ends.append(None if cut == block.end else cuts[cut])
            elif starts and cut < block.end and cuts[cut] is None:
                ends[-1] = None
            start = cut
        if starts:
            ends[-1] = None
    return Atoms(starts, stops, ends)


def units(text: str | None, classifier: Classifier) -> list[tuple[int, int]]:
    """(start, end) of the sentence units of a text, in code points."""
    if not text or not text.strip():
        return []
    own = atoms(text, blocks(text), _writing(text))
    asked = [c for c in own.ends if c is not None]
    verdicts = iter(classifier.says(asked) if asked else [])
    out: list[tuple[int, int]] = []
    start = -1
    for a, b, end in zip(*own):
        start = a if start < 0 else start
        if end is None or next(verdicts):
            out.append((start, b))
            start = -1
    return out


FIELDS = ", ".join(f"{name} string" for name in Context._fields)


def _observe(text: str, counts: Counter) -> Atoms:
    """The atoms of a text; counts contexts of candidates (kind `inside`) and of pairs of a block's end and the next block's start (kind `between`)."""
    cased, own_blocks = _writing(text), blocks(text)
    own = atoms(text, own_blocks, cased)
    counts.update(("inside", *c) for c in own.ends if c is not None)
    last: Context | None = None
    for block in own_blocks:
        if block.single:
            last = None
            continue
        end = ended(text, block)
        if last is not None and end is not None:
            after, shape, following, opened = _first_token(text, block.start, block.end)
            counts["between", *last._replace(after=after, after_shape=shape, after_next=following, opened=opened, cased=cased)] += 1
        last = end
    return own


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two sorts: each text's atoms with the hashed features of their ends, and counts of contexts (with a kind)."""
    counts: Counter[tuple] = Counter()
    known: dict[Context, list[int]] = {}
    ints, flags = pa.list_(pa.int32()), pa.list_(pa.bool_())
    names = ["id", "starts", "stops", "forced", "features", "kind", *Context._fields, "n"]
    kind: pa.DataType | None = None

    def flush() -> pa.RecordBatch:
        n = len(counts)
        out = pa.RecordBatch.from_arrays([pa.nulls(n, kind), pa.nulls(n, ints), pa.nulls(n, ints), pa.nulls(n, flags), pa.nulls(n, ints), *[pa.array(c, pa.string()) for c in zip(*counts)], pa.array(counts.values(), pa.int64())], names)
        counts.clear()
        return out

    for batch in batches:
        kind = batch.column(0).type
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            read = [(i, _observe(t, counts)) for i, t in enumerate(part.column(1).to_pylist()) if t and t.strip()]
            new = list({c for _, own in read for c in own.ends if c is not None and c not in known})
            if len(known) + len(new) > 300_000:
                known.clear()
                new = list({c for _, own in read for c in own.ends if c is not None})
            if new:
                known.update(zip(new, _hashed(new).tolist()))
            n = len(read)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array([i for i, _ in read], pa.int64())), pa.array([own.starts for _, own in read], ints), pa.array([own.stops for _, own in read], ints),
                pa.array([[c is None for c in own.ends] for _, own in read], flags), pa.array([[f for c in own.ends if c is not None for f in known[c]] for _, own in read], ints),
                *[pa.nulls(n, pa.string())] * (1 + len(Context._fields)), pa.nulls(n, pa.int64())], names)
            if len(counts) >= HELD:
                yield flush()
    if counts:
        yield flush()


def _decide_batches(weights: np.ndarray, bias: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units out of atoms: the classifier's word on all their ends at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts, stops, forced, features = (batch.column(i) for i in range(1, 5))
        rows = np.repeat(np.arange(batch.num_rows), np.diff(starts.offsets.to_numpy()))
        a, b, ends = starts.flatten().to_numpy(), stops.flatten().to_numpy(), forced.flatten().to_numpy(zero_copy_only=False).copy()
        if not ends.all():
            ends[~ends] = weights[features.flatten().to_numpy().reshape(np.count_nonzero(~ends), -1)].sum(axis=1) + bias > 0
        last = np.flatnonzero(ends)  # a text's last atom is one of them
        first = np.r_[0, last[:-1] + 1] if len(last) else last
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[last])), pa.array(a[first].astype(np.int64)), pa.array(b[last].astype(np.int64))], ["id", "sent_start", "sent_end"])


def _labelled(contexts: DataFrame) -> DataFrame:
    """Contexts with a reliable label, from where tokens stand in all of the corpus.

    A block's end and the next one's start are a boundary. Inside blocks: no boundary where the token before never ends a
    block or the one behind never starts one, although both are seen often enough, where in usual writing the next word
    is in small letters, behind an initial, and in dates; a boundary where the token before often ends a block and the one
    behind often starts one, and behind ! and ? before a capital.
    """
    # "33 min." and "min. 44": a token behind a number is another case than the same behind a word.
    contexts = contexts.withColumn("counted", F.col("before2").startswith("<"))
    left = contexts.groupBy("before", "counted").agg(F.sum("n").alias("left_n"), F.sum(F.when(F.col("kind") == "between", F.col("n")).otherwise(0)).alias("left_edge"))
    right = contexts.groupBy("after").agg(F.sum("n").alias("right_n"), F.sum(F.when(F.col("kind") == "between", F.col("n")).otherwise(0)).alias("right_edge"))
    joined = contexts.join(left, ["before", "counted"]).join(right, "after")
    usual, small = F.col("cased") == "N", F.col("after_shape").startswith("l")
    number = F.col("before_shape").rlike("^n")
    word_before, word_after = F.col("before").rlike(r"^\p{L}"), F.col("after").rlike(r"^\p{L}")
    date = number & (F.col("mark") == ".") & F.col("after_shape").rlike("^(n|year)") & (F.col("after_next").isin(".", ":") | (F.col("after_shape") == "year"))
    never = (word_before & (F.col("left_n") >= ENOUGH) & (F.col("left_edge") == 0) & (F.col("mark") == ".")) | (word_after & (F.col("right_n") >= ENOUGH) & (F.col("right_edge") == 0))
    often = (F.col("left_edge") >= 0.08 * F.col("left_n")) & (F.col("right_edge") >= 0.08 * F.col("right_n")) & (F.col("left_edge") >= 3) & (F.col("right_edge") >= 3) & ~number
    initial = usual & F.col("before_shape").rlike("^Ur?1$") & (F.col("mark") == ".") & F.col("after_shape").rlike("^[CAU]") & (F.col("space") != "") & ~F.col("before2").startswith("<")
    shout = usual & F.col("mark").rlike("^[!?]+$") & (F.col("closed") == "") & F.col("after_shape").startswith("C") & (F.col("space") != "")
    label = (
        F.when(F.col("kind") == "between", 1.0).when(usual & small & (F.col("space") != ""), 0.0).when(date, 0.0).when(initial, 0.0).when(never, 0.0)
        .when(shout, 1.0).when(often & usual & ~small, 1.0)
    )
    return joined.withColumn("label", label).where("label is not null").select(*Context._fields, "label", "n")


def _scanned(frame: DataFrame, row: str, text: Column) -> DataFrame:
    kind = dict(frame.dtypes)[row]
    given = frame.select(F.col(row).alias("id"), text.alias("text"))
    return checkpointed(spread(given).mapInArrow(_scan, f"id {kind}, starts array<int>, stops array<int>, forced array<boolean>, features array<int>, kind string, {FIELDS}, n bigint"))


def fit(scanned: DataFrame, sample: int = SAMPLE) -> Classifier:
    """A classifier fitted to the reliable boundaries among the contexts of scanned texts.

    All contexts are counted; the fit takes at most `sample` distinct labelled ones, those of the least hashes, which keeps what
    reaches the driver within a fixed bound.
    """
    contexts = checkpointed(scanned.where("kind is not null").groupBy("kind", *Context._fields).agg(F.sum("n").alias("n")))
    keyed = _labelled(contexts).select(*Context._fields, F.xxhash64(*Context._fields, "label").alias("h"), "label", "n")
    hashed = keyed.mapInArrow(_hash_batches, "h bigint, label double, n bigint, f array<int>")
    chosen = hashed.orderBy("h", "f", "label", "n").limit(sample).toArrow()
    rows = chosen.column("f").combine_chunks()
    return Classifier.fit(rows.values.to_numpy().reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), np.int32), chosen.column("label").to_numpy(), chosen.column("n").to_numpy().astype(float))


def train(frame: DataFrame, text: Column, sample: int = SAMPLE) -> Classifier:
    """A classifier fitted to the reliable boundaries of the texts, all of which are read; it may be given to sentence_units."""
    numbered = frame.select(text.alias("text")).where("text is not null").withColumn("id", F.lit(0))
    return fit(_scanned(numbered, "id", F.col("text")), sample)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts to rows of hashed features, so that what reaches the driver is a few numbers a row."""
    width = len(Context._fields)
    for batch in batches:
        if batch.num_rows:
            rows = _hashed([Context(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(width)))])
            offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(width), batch.column(width + 1), batch.column(width + 2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))], ["h", "label", "n", "f"])


def sentence_units(frame: DataFrame, row: str, text: Column, classifier: Classifier | None = None) -> DataFrame:
    """The row id, sent_start, sent_end (BIGINT, code points from 0, the end excluded) of every sentence unit of every text.

    Together the units cover all text but white space. Blank lines and bullet lines end units, quotations and brackets are
    never split, Thai units end at spaces between Thai letters; at other candidates (see candidates) the classifier
    decides, by default one trained on the same texts. Null, empty and blank texts have no units; whole texts are
    processed; repeated rows give repeated results; other columns are ignored; an empty table gives an empty result.

    Texts are read once: their atoms, with the hashed features of each end, are written beside the counts of contexts; the
    classifier then decides on whole batches of ends. Only counts are shuffled, and only the classifier's weights, of a fixed
    size, go to the tasks.
    """
    scanned = _scanned(frame, row, text)
    own = classifier or fit(scanned)
    kind = dict(frame.dtypes)[row]
    found = scanned.where("kind is null").select("id", "starts", "stops", "forced", "features").mapInArrow(partial(_decide_batches, own.weights, own.bias), f"id {kind}, sent_start bigint, sent_end bigint")
    return found.select(F.col("id").alias(row), "sent_start", "sent_end")
