"""N-gram Jaccard self-join by T-occurrence search, with the classes of linked documents.

Two documents link when their sets of five-word shingles have 100 * |A and B| >= 80 * |A or B|. Then B holds at least
T = ceil(0.8 |A|) shingles of A, so it stands in one of A's |A| - T + 1 *shortest* inverted lists.

1. One pass over the texts: set sizes, a digest of each set, and the shingles that repeat within a task's window.
   Equal sets fold into one representative. The most frequent shingles become the end of the common order.
2. A second pass emits the shortest lists' entries of each representative: ``(shingle, doc_id)``.
3. A few guides per document, keys that documents alike tend to share, propose members to centres. A proposal is a
   T-occurrence search of the centre in a bounded block of members: short lists are heap-merged, long ones are only probed
   by bisection (DivideSkip). Proven links form classes. Here as in step 4 short sketches go first, and sets travel for those
   that these do not rule out.
4. Lists whose members fall into one class are finished. Of the others, every pair of members of different classes that
   shares enough lists, one of which must lead in the smaller set, is searched. So no link between classes is lost.
   Members of crowded lists are not paired one by one: each has one home block, and blocks that meet in a crowded list are
   searched against each other as a whole.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow, most_frequent, narrow
from .components import components, merged

SHINGLE = 5
WINDOW_SHINGLES = 2_000_000  # shingles that one frequency window of a task holds
HOT_AT_LEAST = 32  # a shingle counted that often is moved to the end of the common order
MAX_HOT = 1 << 17  # size bound of the table of such shingles; others keep their place, which costs time, not links
FILTER_BITS = 1 << 25  # size of an id filter; it lets some extra ids through when it is full, and never loses one
BLOCK = 512  # members searched together
CROWD = 64  # lists with more members pair blocks of members instead of members
SALTS = 16  # parts of a hot list
BANDS, BAND_ROWS = 8, 3  # guides: documents that agree in a band's minima are likely to link

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xFF51AFD7ED558CCD], np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a whole text.

    A-Z are lower-cased; words are split on the six ASCII blanks. Fewer than five words count as one shingle, a null
    or wordless text as none. The two lowest bits are clear.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64) & ~np.uint64(3)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = w[:n] * _FACTORS[0]
    for k in range(1, SHINGLE):
        h += w[k:k + n] * _FACTORS[k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h = np.sort((h ^ (h >> np.uint64(29))) & ~np.uint64(3))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]  # np.unique takes several times as long


def required(a: int, b: int) -> int:
    """Smallest overlap of two sets of these sizes that links them: 180 * overlap >= 80 * (a + b)."""
    return -(-4 * (a + b) // 9)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = max(len(v) for v in columns.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _scan(batches: Batches) -> Batches:
    """A row per document (size, digest), and rows (shingle, times) for what repeats within a window."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()),
                        ("shingle", pa.int64()), ("seen", pa.int64())])
    window: list[np.ndarray] = []
    held, digests = 0, set()

    def frequent() -> Iterator[pa.RecordBatch]:
        if window:
            values, seen = np.unique(np.concatenate(window), return_counts=True)
            if (often := seen >= 4).any():
                yield _batch(schema, shingle=values[often].view(np.int64), seen=seen[often].astype(np.int64))

    for b in batches:
        sizes, keys = [], []
        for text in b.column("text").to_pylist():
            s = shingle_set(text)
            raw = s.tobytes()
            key = xxhash.xxh3_128_digest(raw) if len(s) else None
            sizes.append(len(s))
            keys.append(key)
            if len(s) and key not in digests:
                digests.add(key)
                window.append(s)
                held += len(s)
        if b.num_rows:
            yield _batch(schema, doc_id=b.column("doc_id"), n=sizes, digest=keys)
        if held > WINDOW_SHINGLES:
            yield from frequent()
            window, held, digests = [], 0, set()
    yield from frequent()


def _bit(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(32)) % np.uint64(FILTER_BITS)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``doc_id`` of fixed size (4 MB), or-ed together by Spark."""
    h = F.col("word")

    def bits(batches: Batches) -> Batches:
        for b in batches:
            at = _bit(b.column(0).to_numpy())
            mask = np.left_shift(np.int64(1), (at % np.uint64(64)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array((at // np.uint64(64)).astype(np.int32)), pa.array(mask)],
                                             names=["word", "mask"])

    words = map_arrow(ids.select("doc_id"), bits, "word int, mask long").groupBy(h).agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = words.toArrow()
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy()
    return out


def _inside(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = _bit(ids)
    return (bitmap[(at // np.uint64(64)).astype(np.int64)] >> (at % np.uint64(64)).astype(np.int64)) & 1 == 1


_ODD = (np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def guides(s: np.ndarray) -> np.ndarray:
    """A key per band of minima under different multipliers; bit 1 marks them."""
    least = (s * _ODD[:, None]).min(axis=1).reshape(BANDS, BAND_ROWS)
    keys = least[:, 0] * _FACTORS[0] + least[:, 1] * _FACTORS[1] + least[:, 2] * _FACTORS[2] + np.arange(BANDS, dtype=np.uint64)
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (keys & ~np.uint64(3)) | np.uint64(2)


def _entries(texts: DataFrame, wanted: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> DataFrame:
    """``shingle, doc_id, lead`` of the |A| - T + 1 shortest lists of each wanted document, and of its guides.

    Hot shingles have bit 0 set, guides bit 1. The first |A| - required(|A|, |A|) + 1 lists lead: sets that link share a
    list that leads in the smaller one.
    """
    shared = texts.sparkSession.sparkContext.broadcast((wanted, hot, rank))

    def run(batches: Batches) -> Batches:
        wanted, hot, rank = shared.value
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            shingles, owners, leads = [], [], []
            for i in np.flatnonzero(_inside(wanted, ids)):
                s = shingle_set(b.column("text")[int(i)].as_py())
                if not len(s):
                    continue
                k = len(s) - (4 * len(s) + 4) // 5 + 1
                at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
                is_hot = hot[at] == s if len(hot) else np.zeros(len(s), bool)
                calm = s[~is_hot][:k]
                if len(calm) < k:
                    late = s[is_hot][np.argsort(rank[at[is_hot]], kind="stable")][:k - len(calm)]
                    calm = np.concatenate([calm, late | np.uint64(1)])
                shingles += [calm, guides(s)]
                owners.append(np.full(len(calm) + BANDS, ids[i]))
                leads.append(np.arange(len(calm) + BANDS) <= len(s) - required(len(s), len(s)))
            if shingles:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(owners)),
                                                  pa.array(np.concatenate(leads))], names=["shingle", "doc_id", "lead"])

    return map_arrow(texts, run, "shingle long, doc_id long, lead boolean")


def _shared_lists(batches: Batches) -> Batches:
    """Sorted rows without the lists of one member; parts of hot lists stay, as their list has other parts."""
    held = None  # the last row so far: its fate hangs on the next one
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b] if held is None else [held[0], b])
        key, part = t.column("shingle").to_numpy(), t.column("part").to_numpy()
        same = np.concatenate([[held is not None and held[1]], (key[1:] == key[:-1]) & (part[1:] == part[:-1]), [False]])
        keep = same[:-1] | same[1:] | (key & 1 == 1)
        out = t.slice(0, len(key) - 1).filter(pa.array(keep[:-1]))
        if out.num_rows:
            yield from out.combine_chunks().to_batches()
        held = (t.slice(len(key) - 1).combine_chunks().to_batches()[0], bool(same[-2]))
    if held is not None and (held[1] or held[0].column("shingle")[0].as_py() & 1):
        yield held[0]


def divide_skip(query: np.ndarray, members: list[np.ndarray]) -> list[int]:
    """Places of the members that link with the query.

    The query's lists over the block are cut into short and long ones. The short ones are merged by a heap; who
    appears there often enough to reach its bound with the long lists is probed in those by bisection.
    """
    sizes = [len(m) for m in members]
    flat = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), sizes)
    at = np.minimum(np.searchsorted(query, flat), len(query) - 1)
    hit = query[at] == flat
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    ends = np.flatnonzero(np.diff(at)) + 1
    lists = sorted((x.tolist() for x in np.split(owner, ends)), key=len) if len(at) else []
    need = [required(len(query), n) for n in sizes]
    least = min(need)
    if len(lists) < least:
        return []
    n_long = min(least - 1, int(least / (0.0085 * math.log(max(2, len(lists[-1]))) + 1)))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    found, last, seen = [], -1, 0

    def settle(m: int, count: int) -> None:
        if count + n_long < need[m]:
            return
        for i, x in enumerate(long):
            if count >= need[m] or count + n_long - i < need[m]:
                break
            j = bisect_left(x, m)
            count += j < len(x) and x[j] == m
        if count >= need[m]:
            found.append(m)

    for m in heapq.merge(*short):
        if m != last:
            if seen:
                settle(last, seen)
            last, seen = m, 0
        seen += 1
    if seen:
        settle(last, seen)
    return found


BLOCK_KEY = ["home_a", "part_a", "home_b", "part_b"]


def _by_query(pairs: DataFrame) -> DataFrame:
    """Rows of blocks with one query: each ``a`` with up to about ``BLOCK`` of its partners."""
    counted = pairs.groupBy("a").agg(F.count("*").alias("k"))
    blocks = pairs.join(counted, "a").select(
        F.col("a").alias("home_a"), F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / BLOCK)).cast("int").alias("part_a"),
        F.lit(0).cast("long").alias("home_b"), F.lit(-1).alias("part_b"), "b")
    members = blocks.select(*BLOCK_KEY, F.col("b").alias("doc_id"), F.col("b").alias("class"), F.lit(False).alias("asks"))
    queries = blocks.select(*BLOCK_KEY, F.col("home_a").alias("doc_id"), F.col("home_a").alias("class"), F.lit(True).alias("asks"))
    return members.union(queries.distinct())


def search_block(queries: list[tuple], members: list[tuple], paired: bool) -> list[tuple[int, int]]:
    """Links ``a, b`` of rows ``(id, class, set)``. ``paired``: every query is meant for every member.

    Otherwise a query looks for members of other classes that are not smaller and not too large. Of two classes that a
    link has joined no further pair is searched.
    """
    links, above = [], {}

    def top(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    ids = np.array([m[0] for m in members])
    sizes = np.array([len(m[2]) for m in members])
    classes = np.array([m[1] for m in members])
    for a, own, query in queries:
        n = len(query)
        if not n:
            continue
        own = top(own)
        able = np.arange(len(members)) if paired else np.flatnonzero(
            (classes != own) & (5 * n >= 4 * sizes) & ((n < sizes) | ((n == sizes) & (a < ids))))
        if not len(able):
            continue
        joined = set()
        for i in divide_skip(query, [members[i][2] for i in able]):
            at = able[i]
            if paired or classes[at] not in joined:
                links.append((a, int(ids[at])))
                joined.add(classes[at])
        if not paired and joined:
            above.update((int(c), own) for c in joined)
            classes[np.isin(classes, list(joined))] = own
    return links


def sketch(s: np.ndarray) -> np.ndarray:
    """Size of a set, and the parity of the number of its shingles in each of 2 to 4 times as many cells, as words of 64.

    Where two sets differ in d shingles, at most d parities differ. Halves of a sketch xor-ed give the sketch of half as
    many cells.
    """
    cells = 1 << max(9, (2 * len(s) - 1).bit_length())
    odd = np.bincount(((s >> np.uint64(2)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.concatenate([np.array([len(s)], np.uint64), np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)])


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def possible(queries: list[tuple], members: list[tuple], paired: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which queries and which members of a block, rows ``(id, class, sketch)``, may have a link there.

    Two sets link when they differ in at most a ninth of their summed sizes; sketches that differ in more rule that out.
    """
    ids, classes = np.array([m[0] for m in members]), np.array([m[1] for m in members])
    sizes = np.array([int(m[2][0]) for m in members])
    widths = np.array([len(m[2]) - 1 for m in members])
    kinds = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths)}
    held = {(w, w): np.stack([members[i][2][1:] for i in at]) for w, at in kinds.items()}
    asking, asked = np.zeros(len(queries), bool), np.zeros(len(members), bool)
    for q, (a, own, query) in enumerate(queries):
        n = int(query[0])
        near = (5 * n >= 4 * sizes) & (5 * sizes >= 4 * n) & (n > 0)
        if not paired:
            near &= (classes != own) & ((n < sizes) | ((n == sizes) & (a < ids)))
        for w, at in kinds.items():
            at = at[inside := near[at]]
            if not len(at):
                continue
            common = min(w, len(query) - 1)
            if (w, common) not in held:
                held[w, common] = _folded(held[w, w], common)
            differ = np.bitwise_count(held[w, common][inside] ^ _folded(query[1:], common)).sum(axis=1, dtype=np.int64)
            at = at[9 * differ <= n + sizes[at]]
            asked[at] = True
            asking[q] |= len(at) > 0
    return asking, asked


Visit = Callable[[tuple, list[tuple], list[tuple]], Iterator[pa.RecordBatch]]


def _each_block(rows: DataFrame, texts: DataFrame, value: Callable[[np.ndarray], np.ndarray], visit: Visit, schema: str) -> DataFrame:
    """What ``visit`` makes of each block's key, those who ask and the others, as ``(id, class, value of the set)``."""
    wanted = rows.sparkSession.sparkContext.broadcast(id_filter(rows.select("doc_id").distinct()))

    def values(batches: Batches) -> Batches:
        bitmap = wanted.value
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            keep = np.flatnonzero(_inside(bitmap, ids))
            if len(keep):
                made = [value(shingle_set(b.column("text")[int(i)].as_py())).tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(made, pa.binary())], names=["doc_id", "value"])

    def run(batches: Batches) -> Batches:
        key, queries, members = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in BLOCK_KEY))
            asks, doc, known = (batch.column(c).to_pylist() for c in ("asks", "doc_id", "class"))
            for i, at in enumerate(keys):
                if at != key:
                    if queries and members:
                        yield from visit(key, queries, members)
                    key, queries, members = at, [], []
                row = (doc[i], known[i], np.frombuffer(batch.column("value")[i].as_py(), np.uint64))
                (queries if asks[i] else members).append(row)
        if queries and members:
            yield from visit(key, queries, members)

    known = map_arrow(texts, values, "doc_id long, value binary")
    ready = rows.join(known, "doc_id").repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, F.col("asks").desc())
    return map_arrow(ready.select(*BLOCK_KEY, "asks", "doc_id", "class", "value"), run, schema)


def _narrowed(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of blocks without those who, by their sketches, have no link there. Whole sets travel for the rest only."""

    def visit(key: tuple, queries: list[tuple], members: list[tuple]) -> Iterator[pa.RecordBatch]:
        for kind, mask in zip((queries, members), possible(queries, members, key[3] < 0)):
            kept = [kind[i] for i in np.flatnonzero(mask)]
            if kept:
                fixed = [pa.repeat(pa.scalar(v, t), len(kept)) for v, t in zip(key, (pa.int64(), pa.int32()) * 2)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array([r[0] for r in kept], pa.int64()), pa.array([r[1] for r in kept], pa.int64()),
                     pa.array([kind is queries] * len(kept))], names=[*BLOCK_KEY, "doc_id", "class", "asks"])

    return _each_block(stage(rows, "blocks"), texts, sketch, visit, ", ".join(
        f"{c} {'int' if c.startswith('part') else 'long'}" for c in BLOCK_KEY) + ", doc_id long, class long, asks boolean")


def _search(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link: in each block of ``rows``, those who ask are searched among the others."""

    def visit(key: tuple, queries: list[tuple], members: list[tuple]) -> Iterator[pa.RecordBatch]:
        if links := search_block(queries, members, key[3] < 0):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    return _each_block(stage(rows, "blocks"), texts, lambda s: s, visit, "a long, b long")


def _is_hot(shingle: Column) -> Column:
    return shingle.bitwiseAND(F.lit(1)) == 1


def _part(shingle: Column, doc_id: Column) -> Column:
    """Hot lists are searched in parts; an ordinary list is one part."""
    return F.when(_is_hot(shingle), F.pmod(F.xxhash64(doc_id), F.lit(SALTS))).otherwise(0).cast("int")


def _able(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes are within 0.8 of each other."""
    x, y = (sizes.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    return pairs.join(x, "a").join(y, "b").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").select("a", "b")


def _led(lists: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of different classes that can still link, from the short lists that hold both.

    Of two sets that link, ``a`` is the smaller one (of equal ones, the smaller id). With I = required(|a|, |a|) they share at
    least I shingles, so one of a's first |a| - I + 1, a list that leads, is among the short lists of ``b``. Documents that
    share a template and have their own words besides meet in no such list unless they are about to link. What two sets
    share outside the lists counted here lies among the last I - 1 shingles of ``a`` or the last T - 1 of ``b``, so
    ``shared`` must make up the rest. Crowded lists are left out: ``_crowds`` searches every pair that meets in one.
    """
    known = lists.filter(F.col("k") <= CROWD).join(sizes, "doc_id")
    a = known.filter("lead").select("shingle", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("class").alias("class_a"))
    b = known.select("shingle", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("class").alias("class_b"))
    near = "class_a <> class_b and 5 * n_a >= 4 * n_b and (n_a < n_b or (n_a = n_b and a < b))"
    shared = a.join(b, "shingle").filter(near).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))
    rest = F.greatest(F.expr("(8 * n_a + 8) div 9"), F.expr("(4 * n_b + 4) div 5"))
    return shared.filter(F.col("shared") >= F.expr("(4 * (n_a + n_b) + 8) div 9") - rest + 1).select("a", "b")


def _crowds(lists: DataFrame) -> DataFrame:
    """Rows of the blocks in which all pairs that meet in a crowded list, where ``a`` leads, are searched.

    The home of a document is the largest of its crowded lists, cut into parts. Documents alike have few homes, so they
    are dealt to few blocks. Two blocks meet where a list holds a leading member of one and a member of the other. A pair
    of documents is in one pair of blocks, whatever the number of its lists; a block goes out once for each that it meets.
    """
    crowded = lists.filter(F.col("k") > CROWD).drop("part")
    home = F.max(F.struct("k", "shingle")).alias("h")
    docs = crowded.groupBy("doc_id").agg(home, F.min("class").alias("class"), F.max("lead").alias("asks"))
    docs = stage(docs.select("doc_id", "class", "asks", F.col("h.shingle").alias("home"), F.pmod(
        F.xxhash64("doc_id"), F.ceil(F.col("h.k") * 2 / BLOCK)).cast("int").alias("part")), "homes")
    spread = crowded.join(docs.select("doc_id", "home", "part"), "doc_id").groupBy("shingle", "home", "part").agg(
        F.max("lead").alias("lead"), F.min("class").alias("low"), F.max("class").alias("high"))

    def side(e: str) -> DataFrame:
        return spread.select("shingle", "lead", *[F.col(c).alias(f"{c}_{e}") for c in ("home", "part", "low", "high")])

    several = "least(low_a, low_b) < greatest(high_a, high_b)"
    meet = stage(side("a").filter("lead").drop("lead").join(side("b").drop("lead"), "shingle").filter(several)
                 .select(*BLOCK_KEY).distinct(), "meet")
    asking = meet.join(docs.filter("asks"), (F.col("home_a") == F.col("home")) & (F.col("part_a") == F.col("part")))
    asked = meet.join(docs, (F.col("home_b") == F.col("home")) & (F.col("part_b") == F.col("part")))
    return asked.select(*BLOCK_KEY, "doc_id", "class", F.lit(False).alias("asks")).union(
        asking.select(*BLOCK_KEY, "doc_id", "class", F.lit(True).alias("asks")))


def _stars(lists: DataFrame, centre) -> DataFrame:
    """Each member with its part's centre, each part's centre with its list's, where their classes differ."""
    rows = lists.select("shingle", "part", F.struct("doc_id", "class").alias("m"))
    parts = rows.groupBy("shingle", "part").agg(centre(F.col("m")).alias("c"), F.count("*").alias("k"))
    inner = rows.join(parts.filter("k > 1").hint("shuffle_hash"), ["shingle", "part"]).select("c", "m")
    hot = parts.filter(_is_hot(F.col("shingle"))).select("shingle", F.col("c").alias("m"))
    tops = hot.groupBy("shingle").agg(centre(F.col("m")).alias("c"))
    return inner.union(hot.join(tops, "shingle").select("c", "m")).filter("c.class <> m.class").select(
        F.col("c.doc_id").alias("a"), F.col("m.doc_id").alias("b"))


def _open(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """The lists whose members are of several classes, with each member's class and the number ``k`` of members."""
    known = lists.join(classes, lists["doc_id"] == classes["id"], "left").select(
        "shingle", "part", "doc_id", "lead", F.coalesce("component", "doc_id").alias("class"))
    mixed = known.groupBy("shingle").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count("*").alias("k")).filter("x <> y")
    return stage(known.join(mixed.hint("shuffle_hash"), "shingle").select("shingle", "part", "doc_id", "lead", "class", "k"), "open")


def _classes(lists: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
    """``id, component`` of the documents that link with another one.

    Guides come first: the members of a guide's list are searched from one centre, then from others while links are
    found. What they miss is found last, when every able pair of the shingles' lists across classes is searched.
    """
    is_guide = F.col("shingle").bitwiseAND(F.lit(2)) == 2
    guide, rest = lists.filter(is_guide), lists.filter(~is_guide)

    def guided(stars: DataFrame) -> DataFrame:
        pairs = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
        return stage(_search(_narrowed(_by_query(stage(_able(pairs, sizes), "pairs")), texts), texts), "links")

    classes = components(guided(_stars(guide.withColumn("class", F.col("doc_id")), F.min)))
    for centre in (F.max, lambda m: F.min_by(m, F.xxhash64(m["doc_id"]))):
        found = guided(_stars(_open(guide, classes), centre))
        if found.isEmpty():
            break
        classes = merged(classes, found)
    left = _open(rest, classes)
    last = _by_query(stage(_led(left, sizes), "pairs")).union(_crowds(left))
    found = stage(_search(_narrowed(last, texts), texts), "links")
    return classes if found.isEmpty() else merged(classes, found)


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document: the smallest id that links reach, itself included.

    Ids are integers; null ids take no part, repeated rows of an id are one document by their first set. Null, empty
    and wordless texts have no shingles and link with nothing. Equal sets fold together before the search.
    """
    spark: SparkSession = docs.sparkSession
    texts = narrow(docs, id_col, text_col).filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    scan = stage(map_arrow(texts, _scan, "doc_id long, n int, digest binary, shingle long, seen long"), "scan")
    sizes = scan.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("digest", "n")).alias("s")).select(
        "doc_id", "s.n", "s.digest")
    heads = sizes.filter("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies"))
    counted = stage(scan.filter("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
                    .filter(F.col("seen") >= HOT_AT_LEAST), "often")
    often = most_frequent(counted, "seen", MAX_HOT).toArrow()
    hot = often.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, rank = hot[order], often.column("seen").to_numpy().astype(np.int64)[order]
    people = stage(heads.select(F.col("head").alias("doc_id"), "n"), "heads")
    entries = _entries(texts, id_filter(people), hot, rank)
    # one shuffle brings each part of a list together; the sorted rows pass by and lists of one member fall out
    dealt = entries.withColumn("part", _part(F.col("shingle"), F.col("doc_id"))).repartition("shingle", "part")
    lists = stage(map_arrow(dealt.sortWithinPartitions("shingle", "part"), _shared_lists,
                            "shingle long, doc_id long, lead boolean, part int"), "lists")

    classes = _classes(lists, people, texts)
    # a set that occurs once is its own head; the others meet their head in parts, as one set may hold a third of all rows
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    copied = heads.filter("copies > 1").select(F.col("digest").alias("d"), F.col("n").alias("size"), "head",
                                               F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    known = sizes.withColumn("salt", salt)
    out = known.join(copied, (known["digest"] == copied["d"]) & (known["n"] == F.col("size")) & (known["salt"] == F.col("s")), "left")
    out = out.select("doc_id", "n", F.coalesce("head", "doc_id").alias("head"))
    return out.join(classes, F.col("head") == classes["id"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "head").alias("component_id"))
