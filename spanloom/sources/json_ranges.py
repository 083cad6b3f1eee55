"""Large JSON lists cut into their elements without parsing them: byte ranges of files, and payloads too large to parse.

A list of records may be one line of one file.  Where a byte stands (inside a string or not, how deep) follows
from all bytes before it, so a file is read in two steps.  First every range says what it does to that state, whether
it begins inside a string or outside; these few numbers are put together in order.  Then every range knows its
state and gives the elements that begin in it; the last one is read on to its end.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range, and bytes scanned at once.
RANGE_BYTES, CHUNK_BYTES = 32 << 20, 1 << 20
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_BLANK = b" \t\r\n"


@dataclass
class State:
    """Where a byte stands: within a string, after an odd number of backslashes, below so many open brackets."""

    inside: bool = False
    escaped: bool = False
    depth: int = 0

    def scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the brackets outside strings, their bytes, and the depth before each; the state moves on."""
        n = len(data)
        escaped = np.zeros(n + 1, bool)
        slashes = np.flatnonzero(data == 92)
        if len(slashes):
            first = np.ones(len(slashes), bool)
            first[1:] = np.diff(slashes) != 1
            heads = np.flatnonzero(first)
            sizes = np.diff(np.concatenate((heads, [len(slashes)])))
            ends = slashes[heads] + sizes
            odd = sizes % 2 == 1
            if self.escaped and slashes[0] == 0:
                odd[0] = not odd[0]
            escaped[ends[odd]] = True
        if self.escaped and n and data[0] != 92:
            escaped[0] = True
        quotes = (data == 34) & ~escaped[:n]
        parity = np.cumsum(quotes, dtype=np.uint8) & 1  # wraps, which keeps what is odd
        step = _STEP[data]
        at = np.flatnonzero((step != 0) & (parity == (1 if self.inside else 0)))
        steps = step[at].astype(np.int64)
        after = self.depth + np.cumsum(steps)
        if n:
            self.inside ^= bool(parity[-1])
            self.escaped = bool(escaped[n])
        if len(at):
            self.depth = int(after[-1])
        return at, data[at], after - steps


def _chunks(data: np.ndarray):
    for a in range(0, len(data), CHUNK_BYTES):
        yield a, data[a : a + CHUNK_BYTES]


def _key_before(data: bytes, at: int) -> str | None:
    """The key whose value begins at the place, if the bytes before hold one."""
    text = data[:at].rstrip(_BLANK)
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip(_BLANK)
    if not text.endswith(b'"'):
        return None
    start = len(text) - 1
    while (start := text.rfind(b'"', 0, start)) >= 0:
        slashes = len(text[:start]) - len(text[:start].rstrip(b"\\"))
        if slashes % 2 == 0:
            try:
                return json.loads(text[start:])
            except ValueError:  # the range was taken to begin on the wrong side of a quote
                return None
    return None


def _key_at(data: np.ndarray, p: int, before: bytes) -> str | None:
    """The key of the value that begins at p; before: the bytes in front of data."""
    near = data[max(0, p - 4096) : p].tobytes()
    return _key_before(before + near, len(before) + len(near)) if p < 4096 else _key_before(near, len(near))


def cut_elements(data: np.ndarray, state: State, wanted: frozenset[str] | None, current: str | None, more=None, before: bytes = b"") -> list[tuple[int, int]]:
    """(first, end) of the object elements that begin in data.

    wanted: None for a list at the top, else the keys of the top object whose lists count; current: the key of the
    list that is open where data begins.  more(end) gives bytes after data until an element is whole; before: the
    bytes in front of data, where a key may stand."""
    level = 1 if wanted is None else 2
    opens, closes, keys = [], [], [(-1, current)]
    for a, chunk in _chunks(data):
        at, kind, depth = state.scan(chunk)
        opens.append(a + at[(kind == 123) & (depth == level)])
        closes.append(a + at[(kind == 125) & (depth == level + 1)])
        if wanted is not None:
            keys += [(int(a + p), _key_at(data, int(a + p), before) if k == 91 else None) for p, k, d in zip(at, kind, depth, strict=True) if d == 1 and k in (91, 123)] if (depth == 1).any() else []
    opens, closes = np.concatenate([*opens, np.zeros(0, np.int64)]), np.concatenate([*closes, np.zeros(0, np.int64)])
    ends = closes[np.searchsorted(closes, opens).clip(max=max(len(closes) - 1, 0))] + 1 if len(closes) else np.zeros(len(opens), np.int64)
    found = list(zip(opens.tolist(), np.where(ends > opens, ends, -1).tolist() if len(opens) else [], strict=True))
    if found and found[-1][1] < 0:  # the last element ends behind data
        if more is None:
            found.pop()
        else:
            end = len(data)
            while True:
                chunk = more(end)
                if not len(chunk):
                    found.pop()
                    break
                at, kind, depth = state.scan(chunk)
                done = at[(kind == 125) & (depth == level + 1)]
                if len(done):
                    found[-1] = (found[-1][0], end + int(done[0]) + 1)
                    break
                end += len(chunk)
    if wanted is not None:
        places, names = [p for p, _ in keys], [k for _, k in keys]
        found = [x for x in found if names[int(np.searchsorted(places, x[0], "right")) - 1] in wanted]
    return found


# ---------------------------------------------------------------- files
def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _read(file, offset: int, size: int) -> bytes:
    return file.read_at(size, offset) if size > 0 else b""


def _starts_escaped(file, offset: int) -> bool:
    n, step = 0, 1
    while n < offset:
        back = _read(file, max(0, offset - n - step), min(step, offset - n))
        run = len(back) - len(back.rstrip(b"\\"))
        n += run
        if run < len(back):
            break
        step = min(step * 16, 1 << 20)
    return n % 2 == 1


def _whole(path: str, a: int, b: int):
    with _open(path) as file:
        return np.frombuffer(_read(file, a, b - a), np.uint8), _starts_escaped(file, a), _read(file, max(0, a - 4096), min(a, 4096))


_SUMMARY = "path string, first long, end long, steps string"


def _summaries(batches):
    """What each range does to the state, from outside and from inside a string: parity, depth, and of what it opens
    last at each depth the key, if that is a list."""
    for batch in batches:
        rows = []
        for path, a, b in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
            data, escaped, before = _whole(path, a, b)
            out = []
            for inside in (False, True):
                state, lists = State(inside, escaped), {}
                for c, chunk in _chunks(data):
                    at, kind, depth = state.scan(chunk)
                    some = ((kind == 91) | (kind == 123)) & (depth <= 1)
                    lists |= dict(zip(depth[some].tolist(), zip((c + at[some]).tolist(), kind[some].tolist(), strict=True), strict=True))
                names = {d: _key_at(data, p, before) if k == 91 else None for d, (p, k) in lists.items()}
                out.append({"inside": state.inside, "depth": state.depth, "lists": names})
            rows.append((path, a, b, json.dumps(out)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["path", "first", "end", "steps"])


def _elements(wanted: dict, count_only: bool):
    def cut(batches):
        for batch in batches:
            for path, a, b, form, inside, depth, current, start in zip(*(batch.column(n).to_pylist() for n in range(8)), strict=True):
                data, escaped, before = _whole(path, a, b)
                with _open(path) as file:
                    tail = []

                    def more(end, a=a, file=file, tail=tail):
                        tail.append(_read(file, a + end, CHUNK_BYTES))
                        return np.frombuffer(tail[-1], np.uint8)

                    found = cut_elements(data, State(inside, escaped, depth), wanted[form], current, more, before)
                if count_only:
                    yield pa.RecordBatch.from_pydict({"path": [path], "first": [a], "n": [len(found)]})
                    continue
                body = data.tobytes() + b"".join(tail)
                for i in range(0, len(found), 5000):
                    part = found[i : i + 5000]
                    yield pa.RecordBatch.from_pydict({"path": [path] * len(part), "index": pa.array(range(start + i, start + i + len(part)), pa.int64()), "value": [body[x:y].decode("utf-8", "replace") for x, y in part]})

    return cut


def files_of(path: str) -> list[tuple[str, int]] | None:
    """(path, bytes) of the files at a place, or None where only Spark can read it."""
    try:
        system, name = fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    info = system.get_file_info(name)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(name)) if info.type == fs.FileType.Directory else []
    files = [(prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    return None if any(p.endswith((".gz", ".bz2", ".zst")) for p, _ in files) else sorted(files)


def read_json_elements(spark: SparkSession, path: str, key: str = "documents", range_bytes: int = RANGE_BYTES) -> DataFrame | None:
    """path, index, value: the objects of each file's JSON list, or of the list under key in its JSON object, as JSON
    texts numbered from 0; one task a range of range_bytes.  None where files cannot be opened at a byte."""
    files = files_of(path)
    if files is None:
        return None
    ranges = [(p, a, min(a + range_bytes, size)) for p, size in files for a in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], "path string, index long, value string")
    spread = lambda rows, ddl: spark.createDataFrame(rows, ddl).repartition(len(rows))
    steps = {(r["path"], r["first"]): json.loads(r["steps"]) for r in spread(ranges, "path string, first long, end long").mapInArrow(_summaries, _SUMMARY).collect()}
    known, states, state, current = {}, [], (False, 0), None
    for p, a, b in ranges:
        if a == 0:
            with _open(p) as file:
                head = _read(file, 0, min(b, 1 << 16)).removeprefix(b"\xef\xbb\xbf").lstrip(_BLANK)[:1]
            known[p], state, current = "list" if head == b"[" else "object", (False, 0), None
        states.append((p, a, b, known[p], *state, current))
        step = steps[p, a][state[0]]
        own = {int(d) + state[1]: k for d, k in step["lists"].items()}
        current = own.get(1, current)
        state = (step["inside"], state[1] + step["depth"])
    ddl = "path string, first long, end long, form string, inside boolean, depth long, current string, start long"
    wanted = {"list": None, "object": frozenset([key])}
    counts = {(r["path"], r["first"]): r["n"] for r in spread([(*s, 0) for s in states], ddl).mapInArrow(_elements(wanted, True), "path string, first long, n long").collect()}
    placed, start = [], 0
    for s in states:
        start = 0 if s[1] == 0 else start
        placed.append((*s, start))
        start += counts[s[0], s[1]]
    return spread(placed, ddl).mapInArrow(_elements(wanted, False), "path string, index long, value string")


# ---------------------------------------------------------------- payloads
#: Bytes beyond which a payload is cut, well below what a VARIANT holds, and bytes of a piece.
LARGE_BYTES, PIECE_BYTES = 64 << 20, 8 << 20


def split_payloads(payloads: DataFrame, keys: tuple[str, ...] = ("documents", "PubTator3"), column: str = "payload", large_bytes: int | None = None) -> DataFrame:
    """payloads + piece_start: a payload of more than large_bytes comes as pieces that hold some elements of its list
    each, in order; piece_start counts the elements before.  Others come as they are, with 0.

    The list is the payload itself, or stands under the first of the keys that holds one; pieces have the same form.
    What else such a payload holds is left out; one without such a list of objects comes as it is."""
    small, whole = payloads_by_size(payloads, keys, column, large_bytes)
    return small.unionByName(whole)


def payloads_by_size(payloads: DataFrame, keys: tuple[str, ...] = ("documents", "PubTator3"), column: str = "payload", large_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The two tables that ``split_payloads`` puts together: payloads as they are, which stay where they lie, and pieces."""
    large = F.octet_length(column) > (large_bytes or LARGE_BYTES)
    small = payloads.where(~large | F.col(column).isNull()).withColumn("piece_start", F.lit(0).cast("long"))
    others = [c for c in payloads.columns if c != column]
    schema = ", ".join([*(f"`{c}` {payloads.schema[c].dataType.simpleString()}" for c in others), f"`{column}` string", "piece_start long"])

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(len(others))[row].as_py()
                data = np.frombuffer(text.encode(), np.uint8)
                listed = text.lstrip()[:1] == "["
                for key in [None] if listed else keys:
                    found = cut_elements(data, State(), None if listed else frozenset([key]), None)
                    if found:
                        break
                head, foot = (b"[", b"]") if listed else (json.dumps({key: []})[:-2].encode(), b"]}")
                raw, at = data.tobytes(), 0
                pieces = [] if found else [(text, 0)]
                while at < len(found):
                    stop = at + 1
                    while stop < len(found) and found[stop][1] - found[at][0] <= PIECE_BYTES:
                        stop += 1
                    body = b",".join(raw[x:y] for x, y in found[at:stop])
                    pieces.append(((head + body + foot).decode(), at))
                    at = stop
                for piece, start in pieces:
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(row, 1) for i in range(len(others))), pa.array([piece], pa.string()), pa.array([start], pa.int64())], [*others, column, "piece_start"])

    whole = payloads.where(large).select(*others, column).mapInArrow(cut, schema)
    return small.select(*others, column, "piece_start"), whole


def unparsable(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """The other columns of payloads that cannot be parsed, with status and reason."""
    others = [c for c in payloads.columns if c != column]
    split = split_payloads(payloads, column=column)
    bad = split.where(F.col(column).isNull() | F.try_parse_json(column).isNull())
    reason = F.when(F.col(column).isNull(), "no payload").when(F.octet_length(column) > LARGE_BYTES, "too large to parse and without a list of documents").otherwise("no valid JSON")
    return bad.select(*others, F.lit("failed").alias("status"), reason.alias("reason"))
