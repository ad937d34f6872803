"""Document fingerprints: a Merkle tree over paragraphs and sections.

Leaves are sentences or stretches of at most LEAF_CHARS characters or one word, so that
an edit in a long paragraph stays local. Nodes hash their children: a paragraph its leaves,
a section (blank lines part sections, and long ones are cut by content) its paragraphs,
the root its sections. A fingerprint writes the tree as text: equal roots mean equal
texts, and differing branches lead to the edits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, written

#: A leaf ends after a sentence, or with the first word from here on whose hash says so.
_LEAF = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|\Z)")
_WORD = re.compile(r"\s*\S+")
_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")
LEAF_CHARS = 240
#: A section ends at a blank line, or after a paragraph whose hash is divisible by this.
SECTION_CUT = 8
#: Ranges of documents that are dealt out at once, at most.
MOST_RANGES = 1 << 15


def leaves(paragraph: str) -> list[str]:
    """Sentences; of one that is long, pieces that end at words chosen by their content."""
    out = []
    for m in _LEAF.finditer(paragraph):
        s = m.group()
        if len(s) <= LEAF_CHARS:
            if s:
                out.append(s)
            continue
        start = 0
        for w in _WORD.finditer(s):
            if w.end() - start > 2 * LEAF_CHARS:  # a word of that length, as in scripts without spaces
                ends = _cuts(s[start : w.end()])
                out += [s[start + i : start + j] for i, j in zip([0, *ends], ends)]
                start += ends[-1] if ends else 0
            elif w.end() - start >= LEAF_CHARS // 4 and (xxhash.xxh32_intdigest(w.group().encode("utf-8", "surrogatepass")) % 8 == 0 or w.end() - start >= LEAF_CHARS):
                out.append(s[start : w.end()])
                start = w.end()
        if start < len(s):
            out.append(s[start:])
    return out


def _cuts(text: str) -> list[int]:
    """Places to cut text without spaces: after four characters whose hash says so, a quarter of LEAF_CHARS apart at least and LEAF_CHARS at most."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = c[3:] + c[2:-1] * np.uint64(31) + c[1:-2] * np.uint64(961) + c[:-3] * np.uint64(29791)
    chosen = np.flatnonzero((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58) == 0) + 4
    out, last = [], 0
    for k in chosen.tolist():
        while k - last > LEAF_CHARS:
            last += LEAF_CHARS
            out.append(last)
        if k - last >= LEAF_CHARS // 4:
            last = k
            out.append(last)
    while len(text) - last > LEAF_CHARS:
        last += LEAF_CHARS
        out.append(last)
    return out


def _node(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"\x01" + b"".join(children)).digest()


def tree(text: str) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, list[tuple[int, bytes]]]]]]]:
    """``(root, [(section, [(paragraph, [(code points, leaf)])])])``; the leaves' texts laid end to end are the text."""
    sections, now = [], []
    sha = hashlib.sha256

    def close() -> None:
        if now:
            sections.append((_node([p for p, _ in now]), list(now)))
            now.clear()

    for line in _LINE.findall(text) if "\n" in text or "\r" in text else [text] if text else []:
        own = [(len(s), sha(b"\x00" + s.encode("utf-8", "surrogatepass")).digest()) for s in leaves(line)]
        node = _node([h for _, h in own])
        now.append((node, own))
        if not line.strip() or node[0] % SECTION_CUT == 0:
            close()
    close()
    return _node([s for s, _ in sections]), sections


def write(t) -> str:
    """``root|section:paragraph:size,leaf;size,leaf/paragraph...|...``: the root in full, other nodes with 16 and leaves with 12 hex digits."""
    root, sections = t
    return "|".join([root.hex(), *(f"{s[:8].hex()}:" + "/".join(f"{p[:8].hex()}:" + ";".join(f"{n},{h[:6].hex()}" for n, h in own) for p, own in parts) for s, parts in sections)])


def fingerprint(text: str | None) -> str:
    return write(tree(text or ""))


def _read(fp: str) -> tuple[str, list[tuple[str, list[tuple[str, list[tuple[int, str]]]]]]]:
    root, *sections = fp.split("|")
    out = []
    for s in sections:
        name, _, rest = s.partition(":")
        parts = []
        for p in rest.split("/"):
            node, _, own = p.partition(":")
            parts.append((node, [(int(n), h) for n, _, h in (x.partition(",") for x in own.split(";") if x)]))
        out.append((name, parts))
    return root, out


def _bag(t) -> Counter:
    bag: Counter = Counter()
    for _, parts in t[1]:
        for _, own in parts:
            for n, h in own:
                bag[h if isinstance(h, str) else h[:6].hex()] += n
    return bag


def _common(a: Counter, b: Counter) -> float:
    total = sum(a.values()) + sum(b.values())
    return 2 * sum(min(n, b[h]) for h, n in a.items() if h in b) / total if total else 1.0


def likeness(a: str, b: str) -> float:
    """Share of two texts' code points that lie in common leaves (Dice, repeats counted); 1 if the roots are equal."""
    return 1.0 if a.split("|", 1)[0] == b.split("|", 1)[0] else _common(_bag(_read(a)), _bag(_read(b)))


def _differing(a: list, b: list) -> list[tuple[int, int, int, int]]:
    """Stretches ``(start, end, start, end)`` of two lists between which they are equal.

    Common ends are taken off; then elements that occur once in both, in an order that
    both share, part the lists, and so on within the parts.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
        if i == j and k == m:
            continue
        once = Counter(a[i:j]) if i < j and k < m else Counter()
        also = Counter(b[k:m]) if once else Counter()
        at = {x: p for p, x in enumerate(a[i:j], i) if once[x] == 1 and also[x] == 1} if also else {}
        tails: list[int] = []  # the longest rising row of places in a
        chain: list[tuple[int, int, int]] = []
        ends: list[int] = []
        for q in range(k, m) if at else ():
            p = at.get(b[q])
            if p is not None:
                n = bisect_left(tails, p)
                chain.append((p, q, ends[n - 1] if n else -1))
                if n == len(tails):
                    tails.append(p), ends.append(0)
                tails[n], ends[n] = p, len(chain) - 1
        if not tails:
            out.append((i, j, k, m))
            continue
        n, last = ends[-1], (j, m)
        while n >= 0:
            p, q, n = chain[n]
            todo.append((p + 1, last[0], q + 1, last[1]))
            last = (p, q)
        todo.append((i, last[0], k, last[1]))
    return sorted(out, key=lambda x: (x[2], x[3]))


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Ranges of code points in the second text that differ from the first, found by going down differing branches only.

    Branches are aligned in order, so a passage that moved is an edit where it is now; a
    range is empty where something was taken out.
    """
    (ra, sa), (rb, sb) = _read(a), _read(b)
    if ra == rb:
        return []
    ends, at = [], 0  # where the leaves of b begin, by section and paragraph
    for _, parts in sb:
        own = []
        for _, leaf in parts:
            begin = at
            at += sum(n for n, _ in leaf)
            own.append(begin)
        ends.append(own)
    out: list[tuple[int, int]] = []
    for i, j, k, m in _differing([s for s, _ in sa], [s for s, _ in sb]):
        pa_, pb = [p for _, parts in sa[i:j] for p in parts], [p for _, parts in sb[k:m] for p in parts]
        begins = [x for own in ends[k:m] for x in own]
        after = at if m == len(sb) else ends[m][0] if ends[m] else at
        for x, y, u, v in _differing([p for p, _ in pa_], [p for p, _ in pb]):
            la, lb = [n for _, own in pa_[x:y] for n in own], [n for _, own in pb[u:v] for n in own]
            place = begins[u] if u < len(begins) else after
            starts = [place]
            for n, _ in lb:
                starts.append(starts[-1] + n)
            out += [(starts[f], starts[t]) for _, _, f, t in _differing(la, lb)]
    return out or [(0, at)]


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of another text."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 2_000) -> DataFrame:
    """``(id, text, part, own)``: the rows dealt to ranges of descending id, and for each range the row that follows its last.

    Rows are ordered by id descending (null last), then by a hash of the text and of
    their place. The ranges are cut where a sorted list of keys alone says, so only
    keys are ordered globally and each text moves once. ``docs`` is read twice and must
    come in the same order, as a table of files does.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text", F.monotonically_increasing_id()))
    keys = written(rows.select("id", "h"), "keys")
    total = keys.count()
    ranges = min(MOST_RANGES, max(1, -(-total // rows_per_range)))
    share = min(1.0, 32.0 * ranges / max(1, total))
    probe = keys.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sorted(((r["id"] is not None, r["id"] if r["id"] is not None else 0, r["h"]) for r in probe.limit(64 * ranges).collect()), reverse=True)
    cuts = sorted({(not p, -i, -h) for p, i, h in sample[:: max(1, len(sample) // ranges)]})
    shared = docs.sparkSession.sparkContext.broadcast(cuts)
    kind = rows.schema["id"].dataType.simpleString()

    def part_of(i, h) -> int:
        return bisect_left(shared.value, (i is None, -(i or 0), -h))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [part_of(i, h) for i, h in zip(b.column("id").to_pylist(), b.column("h").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), pa.array(parts, pa.int64())], ["id", "h", "part"])

    order = F.struct(F.col("id").isNotNull().alias("p"), F.coalesce(F.col("id"), F.lit(0)).alias("i"), F.col("h"))
    heads = keys.mapInArrow(ends, f"id {kind}, h long, part long").groupBy("part").agg(F.max(order).alias("o")).orderBy("part").collect()
    # each range also gets the first row of the range after it; the last one that of the first
    also: dict[tuple, list[int]] = {}
    for k, r in enumerate(heads):
        if k:
            also.setdefault((r["o"]["p"], r["o"]["i"], r["o"]["h"]), []).append(heads[k - 1]["part"])
    if heads:
        also.setdefault((heads[0]["o"]["p"], heads[0]["o"]["i"], heads[0]["o"]["h"]), []).append(heads[-1]["part"])
    wrap = heads[-1]["part"] if heads else 0
    first = heads[0]["part"] if heads else 0
    told = docs.sparkSession.sparkContext.broadcast(also)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, part, role = [], [], []
            for k, (i, h) in enumerate(zip(b.column("id").to_pylist(), b.column("h").to_pylist())):
                home = part_of(i, h)
                take.append(k), part.append(home), role.append(0)
                for p in told.value.get((i is not None, i or 0, h), ()):
                    take.append(k), part.append(p), role.append(2 if p == wrap and home == first else 1)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(take, pa.int64())) for c in b.columns), pa.array(part, pa.int64()), pa.array(role, pa.int32())], [*b.schema.names, "part", "role"])

    return rows.mapInArrow(deal, f"id {kind}, text string, h long, part long, role int")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_at)`` for every row.

    A row's next is the one with the next smaller id, and the first row's text follows
    the last; repeated ids are ordered by a hash of the text and of their place, so equal
    rows may be each other's next. Null texts count as empty, null ids come last. A
    single row is its own next. ``edited_at``: ranges that the edit changed. Other
    columns are not read.
    """
    dealt = with_next(docs, id_col, text_col)
    kind = dealt.schema["id"].dataType.simpleString()
    ranged = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, its text and its tree
        for b in chunks(batches, "text"):
            out: list[tuple] = []
            for i, text, part, role in zip(*(b.column(c).to_pylist() for c in ("id", "text", "part", "role"))):
                t = tree(text)
                if held and held[2] == part:
                    out.append(_row(*held, text, t))
                held = (i, text, part, t) if role == 0 else None
            cols = list(zip(*out)) or [[]] * len(names)
            types = [b.schema.field("id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), ranged]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names)

    placed = dealt.repartition(F.col("part")).sortWithinPartitions("part", "role", F.col("id").desc_nulls_last(), F.col("h").desc())
    return placed.mapInArrow(run, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_at array<struct<start:long,end:long>>")


def _row(i, text, part, t, following, t_next) -> tuple:
    changed = edited(text, following)
    t_edited = t if changed == text else tree(changed)
    a, b = write(t), write(t_edited)
    own = _bag(t)
    near = 1.0 if t[0] == t_edited[0] else _common(own, _bag(t_edited))
    near_next = 1.0 if t[0] == t_next[0] else _common(own, _bag(t_next))
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return i, len(text), digest, a, b, near, near_next, [{"start": s, "end": e} for s, e in edits(a, b)]
