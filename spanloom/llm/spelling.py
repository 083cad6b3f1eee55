"""Spelling variant grouping: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point makes one the other.  With L the longer length
that is: common prefix plus common suffix reach L - 1, for words of equal length or of L and L - 1.  Then one of the two
covers at least half of L - 1, so near words share their first or their last L // 2 code points:

1.  Every word is dealt under these two keys, as a word of length L and as the shorter one of L + 1.  Keys that no
    pair can have are left out.  A key of more than ``tile_rows`` words is cut into blocks by the words' own hash,
    and each two blocks (and each block with itself) form a tile, so no key lands in one task.
2.  In a task the rows are cut into blocks of code-point matrices, padded on the right for prefixes and on the left
    for suffixes.  Block pairs that share a key are compared densely: all prefix and suffix lengths at once.
3.  Near words are counted, the most frequent one is picked, and its chain is followed by pointer doubling: every
    form is at least ``factor`` times as frequent as its word, so chains are short and have no cycle.

Defined results: null and empty words and rows of no count are left out, repeated rows of one word are summed, ties of
frequency go to the word that is smallest in code-point order; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, frugal

LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
TILE_ROWS, TASK_ROWS = 2048, 200_000
#: Rows of a dense block, and cells (rows x rows x code points) that a block pair may have.
BLOCK, CELLS = 128, 1 << 22
#: Jumps double each round: 2**6 forms in a row would need a count of 5**64.
ROUNDS = 6
LETTERS = "[A-Za-zÀ-ÿ]+"


# ---------------------------------------------------------------- words of a corpus
def letter_runs(text: Column | str) -> Column:
    """Maximal runs of Latin letters, A-Z lower-cased; null text has none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(LETTERS), F.lit(0)), F.array().cast("array<string>"))


def misspelt(doc_id: Column | str, word: Column, one_in: int = 199) -> Column:
    """word, without one code point in one of one_in pairs of document and word, as their crc32 decides."""
    id_ = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    h = F.crc32(F.concat(id_, F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def count_words(docs: DataFrame, *, text_col: str = "text", change=None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of all letter runs that are long and frequent enough; change: a function of a run, applied first.

    Counts are summed in every task before they are shuffled, so a word of every text costs a row a task."""
    words = docs.select("*", F.explode(letter_runs(text_col)).alias("_word")).where(F.length("_word") >= least_length)
    if change is not None:
        words = words.withColumn("_word", change(F.col("_word"))).where(F.length("_word") >= least_length)
    return words.groupBy(F.col("_word").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- dense tiles
def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, padded on the right and on the left, and the lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    if flat.max(initial=0) < 256:
        flat = flat.astype(np.uint8)
    left, right = np.zeros((len(words), width), flat.dtype), np.zeros((len(words), width), flat.dtype)
    inside = np.arange(width) < size[:, None]
    left[inside] = flat
    right[inside[:, ::-1]] = flat
    return left, right, size


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns each row of a shares with each row of b; padding counts for nothing."""
    equal = (a[:, None, :] == b[None, :, :]) & (a[:, None, :] != 0)
    return np.where(equal.all(axis=2), equal.shape[2], np.argmin(equal, axis=2))


def tile_pairs(words: list[str], key: np.ndarray, side: np.ndarray, other: np.ndarray, half: int, width: int, by_suffix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows i, j of near words of one length class.  key: ascending tile numbers; side and other: the row's block and the
    block it meets; the class holds words of width and width - 1 code points, pairs need one of width."""
    step = max(1, min(BLOCK, int((CELLS / width) ** 0.5)))
    left, right, size = _matrices(words, width)
    found = []
    for a in range(0, len(words), step):
        b = a
        while b < len(words) and key[b] <= key[min(a + step, len(words)) - 1]:
            x, y = slice(a, a + step), slice(b, b + step)
            prefix, suffix = _agree(left[x], left[y]), _agree(right[x][:, ::-1], right[y][:, ::-1])
            near = (prefix + suffix >= width - 1) & (key[x][:, None] == key[y][None, :])
            near &= np.maximum(size[x][:, None], size[y][None, :]) == width
            near &= (side[x] == other[x])[:, None] | (side[x][:, None] != side[y][None, :])
            if by_suffix:
                near &= prefix < half  # else the pair stands under its prefix
            i, j = np.nonzero(near)
            keep = i + a < j + b
            found.append((i[keep] + a, j[keep] + b))
            b += step
    return tuple(np.concatenate([*(f[n] for f in found), np.zeros(0, np.int64)]) for n in (0, 1))


_PAIRS = "word string, near string, near_n long"


def _tiles(table: pa.Table) -> pa.Table:
    table = table.sort_by([(c, "ascending") for c in ("width", "suffix", "part", "low", "high", "word")])
    words, counts = table["word"].to_pylist(), table["n"].to_numpy()
    names = list(zip(*(table[c].to_pylist() for c in ("width", "suffix", "part", "low", "high")), strict=True))
    low, high, block = (table[c].to_numpy() for c in ("low", "high", "block"))
    out, at = ([], []), 0
    for (width, suffix), group in groupby(names, key=lambda x: x[:2]):
        group = list(group)
        key = np.cumsum([0, *(x != y for x, y in zip(group, group[1:], strict=False))])
        own = slice(at, at + len(group))
        i, j = tile_pairs(words[own], key, block[own], np.where(low[own] == high[own], block[own], -1), width // 2, width, suffix)
        out[0].append(i + at)
        out[1].append(j + at)
        at += len(group)
    i, j = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in out)
    a, b = np.concatenate((i, j)), np.concatenate((j, i))
    return pa.table({"word": pa.array([words[x] for x in a.tolist()], pa.string()), "near": pa.array([words[x] for x in b.tolist()], pa.string()), "near_n": pa.array(counts[b], pa.int64())})


def near_words(words: DataFrame, *, tile_rows: int = TILE_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """word, near, near_n: every ordered pair of near words.  words: distinct words with n, best read from a table."""
    length, name = F.length("word"), ["width", "suffix", "part"]
    roles = words.select("word", "n", F.explode(F.array(*(F.struct((length + more).alias("width"), F.lit(bool(s)).alias("suffix")) for more in (0, 1) for s in (0, 1)))).alias("r"))
    half = F.expr("r.width div 2").cast("int")
    keys = roles.select("word", "n", "r.width", "r.suffix", F.when(F.col("r.suffix"), F.substring("word", length - half + 1, half)).otherwise(F.substring("word", F.lit(1), half)).alias("part"))
    sizes = keys.groupBy(name).agg(F.count("*").alias("rows"), F.count_if(length == F.col("width")).alias("long")).where((F.col("rows") > 1) & (F.col("long") > 0))
    blocks = F.ceil(F.col("rows") / tile_rows).cast("int")
    total = sizes.agg(F.sum(F.col("rows") * blocks)).first()[0] or 0
    tasks = max(8, -(-int(total) // task_rows))
    dealt = keys.join(sizes.select(*name, blocks.alias("blocks")), name).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*name, "word", "n", "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    task = F.pmod(F.xxhash64(*name, "low", "high"), F.lit(tasks)).cast("int").alias("task")
    return dealt.select("*", task).repartition(tasks, "task").groupBy("task").applyInArrow(frugal(_tiles), _PAIRS)


# ---------------------------------------------------------------- forms
def _roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form: each round every word jumps twice as far."""
    jumps = checkpointed(forms.select("word", F.col("form").alias("root")))
    for _ in range(ROUNDS):
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = checkpointed(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        jumps = ahead.drop("moved")
        if ahead.where("moved").isEmpty():
            break
    return jumps


def group_variants(words: DataFrame, *, factor: int = FACTOR, tile_rows: int = TILE_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """word, form, root, n, n_near, form_n.  words: word and n.  A word's form is its most frequent near word, if that is
    at least factor times as frequent; its root is the last of its forms, or the word itself."""
    clean = words.where("word <> '' AND n > 0").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    vocabulary = checkpointed(clean)  # read for keys, sizes and the result; counted once
    pairs = near_words(vocabulary, tile_rows=tile_rows, task_rows=task_rows)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best.near", (-F.col("best.less")).alias("near_n"))
    is_form = F.col("near_n") >= factor * F.col("n")
    judged = checkpointed(judged.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")))
    return judged.join(_roots(judged.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
