"""SimHash near-duplicates over a distributed Gray-order hierarchical index.

*Fingerprints* come from an Arrow stage that hashes every shingle of a batch at
once. *Links* are found over distinct fingerprints only:

* Upper nodes. Fingerprints within ``d`` bits agree on at least one of ``d + 1``
  blocks of bits, so each fingerprint enters ``d + 1`` upper nodes, one for each
  block, whose masked pattern (block mask, bits) all its members share. A
  node that is too large for a task is split again over its free bits in the same way, so
  shared masks accumulate; as members differ, a node with few free bits is small.
* Inside a node, members are sorted by Gray rank, so neighbours differ in few
  bits; runs of the sorted order become leaf groups with the AND and OR of their
  members, and runs of leaves the next level. A query adds up the bits on which it differs
  from a group's shared pattern and skips the whole group beyond ``d``; survivors are
  compared exactly.
* A node emits a spanning forest of its links, never all pairs. Components are
  then joined across nodes with star contraction.

:func:`near_duplicates` links 64-bit fingerprints of word shingles. :func:`similar_documents` is
for similarity thresholds such as 0.8 on five-word shingles. The same fingerprints and index make its first
classes, and an exact check of the shingle sets follows within each. At such thresholds many pairs differ
in about ten bits, beyond the reach of the index, so there is an exact way for the rest: similar sets of
different classes share one of the rarest shingles that more than one class has, which joins the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialise, release, split_join, text_or_empty
from .components import components
from .shingles import FOLD_AZ, batches_by_bytes, clean_words, majority_bits, shingle_hashes

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
#: Rows of a node that one task links; a larger one is split by more bits.
NODE_ROWS = 4096
LEAF = 32
#: A fingerprint that more than this share of all rows has is joined without moving them.
HOT_SHARE = 1 / 256
#: Text bytes whose shingle sets one step makes; shingles of a part of a large group; rows of a group that all its parts see.
SET_BYTES = 1 << 20
PART_SHINGLES = 1_000_000
HUBS = 8
#: A shingle in over this share (and number) of a sample of about so many rows is hot: its rows are dealt over
#: SALTS tasks, and it comes last in the order of shingles. Neither changes which pairs are found. At most
#: 256 times a document's mean shingles are hot.
HOT_SHINGLE, HOT_LEAST, HOT_SAMPLE = 1 / 256, 32, 32_768
SALTS = 4096
HOT_RANK = 2**62
SET = "__tl_group long, __tl_row long, __tl_v long, __tl_n long, __tl_set binary"
SET_NAMES = ["__tl_group", "__tl_row", "__tl_v", "__tl_n", "__tl_set"]
LINK = "a long, b long, u long, v long"

# ---------------------------------------------------------------- fingerprints


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(id, fp)`` for every row: 64-bit SimHash as a signed long.

    A bit is set when over half of the shingle hashes have it. Texts of fewer
    words than a shingle are one shingle; texts without words (also null) get 0.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in batches_by_bytes(batch, "text"):
                buf, starts, ends, first = clean_words(part.column("text"), FOLD_AZ)
                hashes, counts = shingle_hashes(buf, starts, ends, first, words)
                fp = majority_bits(hashes, counts)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return slim.mapInArrow(stage, f"id {id_type}, fp long")


# ---------------------------------------------------------------- index


def _block_masks(mask: int, parts: int) -> list[int]:
    """Split the set bits of ``mask`` into ``parts`` runs of nearly equal length."""
    bits = [i for i in range(63, -1, -1) if mask >> i & 1]
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _route(items: DataFrame, distance: int, masks: list[int]) -> DataFrame:
    """Each item in its child nodes, one per block of the bits its node leaves free; ``masks`` are all free masks there are."""
    signed = lambda x: F.lit(x - 2**64 if x >= 2**63 else x).cast("long")
    blocks = {m: _block_masks(m, distance + 1) for m in masks}
    table = F.create_map(*[x for m in masks for x in (signed(m), F.array(*[signed(b) for b in blocks[m]]))])
    each = items.select("*", F.posexplode(F.element_at(table, F.col("__tl_mask"))).alias("__tl_k", "__tl_block"))
    shared = F.hex(F.col("__tl_fp").bitwiseAND(F.col("__tl_block")))
    return each.select(
        F.concat("__tl_path", F.lit("/"), F.col("__tl_k").cast("string"), F.lit(":"), shared).alias("__tl_path"),
        F.col("__tl_mask").bitwiseAND(F.bitwise_not("__tl_block")).alias("__tl_mask"),
        "__tl_fp",
    )


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def link_node(fps: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one node, as index pairs.

    Members link at ``distance`` or fewer differing bits.
    """
    n = len(fps)
    if n < 2:
        return []
    order = np.argsort(gray_rank(fps), kind="stable")
    codes = fps[order]
    label = np.arange(n)
    out: list[tuple[int, int]] = []

    def take(i: np.ndarray, j: np.ndarray) -> None:
        """Add what joins two trees; pairs inside one tree are dropped before any other test."""
        nonlocal label
        fresh = label[i] != label[j]
        i, j = i[fresh], j[fresh]
        if not len(i):
            return
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        _, one = np.unique(low * n + high, return_index=True)
        parent = label.copy()

        def root(x: int) -> int:
            while parent[x] != x:
                x = parent[x]
            return x

        for at in one.tolist():
            a, b = root(low[at]), root(high[at])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(order[i[at]]), int(order[j[at]])))
        while (flat := parent[parent]).tolist() != parent.tolist():
            parent = flat
        label = parent

    near = np.flatnonzero(np.bitwise_count(codes[1:] ^ codes[:-1]) <= distance)
    take(near, near + 1)  # Gray neighbours first: much of the forest is made here
    heads = np.arange(0, n, LEAF)
    all_of, any_of = np.bitwise_and.reduceat(codes, heads), np.bitwise_or.reduceat(codes, heads)
    shared = ~(all_of ^ any_of)
    upper = np.arange(0, len(heads), LEAF)
    up_and, up_or = np.bitwise_and.reduceat(all_of, upper), np.bitwise_or.reduceat(any_of, upper)
    up_shared = ~(up_and ^ up_or)
    for at in heads.tolist():
        query = codes[at : at + LEAF]
        # Differences accumulate downwards: a group's shared bits contain its parent's.
        reach = (np.bitwise_count((query[:, None] ^ up_and) & up_shared) <= distance).any(axis=0)
        leaves = (upper[reach][:, None] + np.arange(LEAF)).ravel()
        leaves = leaves[(leaves < len(heads)) & (leaves >= at // LEAF)]
        hit = (np.bitwise_count((query[:, None] ^ all_of[leaves]) & shared[leaves]) <= distance).any(axis=0)
        leaves = leaves[hit]
        if not len(leaves):
            continue
        rows = (heads[leaves][:, None] + np.arange(LEAF)).ravel()
        rows = rows[rows < n]
        i, k = np.nonzero(np.bitwise_count(query[:, None] ^ codes[rows]) <= distance)
        i, j = i + at, rows[k]
        keep = i < j
        take(i[keep], j[keep])
    return out


def by_path(emit):
    """Arrow stage that calls ``emit`` with the batches of each run of equal ``__tl_path``."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, parts = None, []
        for batch in batches:
            runs = batch.column("__tl_path").to_pylist()
            cuts = [0, *[i for i in range(1, len(runs)) if runs[i] != runs[i - 1]], len(runs)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if runs[a] != open_path:
                    if parts and (done := emit(parts)) is not None:
                        yield done
                    open_path, parts = runs[a], []
                parts.append(batch.slice(a, z - a))
        if parts and (done := emit(parts)) is not None:
            yield done

    return stage


def _link_nodes(distance: int):
    """Nodes arrive sorted by path; each is linked on its own. Emits (u, v) of linked fingerprints."""

    def emit(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        fps = np.concatenate([p.column("__tl_fp").to_numpy() for p in parts])
        pairs = link_node(fps.view(np.uint64), distance)
        if not pairs:
            return None
        i, j = np.array(pairs).T
        return pa.RecordBatch.from_arrays([pa.array(fps[i]), pa.array(fps[j])], ["u", "v"])

    return by_path(emit)


def _by_task(frame: DataFrame) -> DataFrame:
    """Nodes to tasks. The number is given, as small rows can mean much work and must not be merged into one task."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(parts, "__tl_path").sortWithinPartitions("__tl_path")


def links(items: DataFrame, distance: int = MAX_DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """Spanning links ``(u, v)`` among the distinct fingerprints ``items(__tl_fp)``.

    A task has one node of at most ``node_rows`` rows at a time, or of 2 ** (distance + 1) if that is more.
    """
    todo = items.select(F.lit("").alias("__tl_path"), F.lit(-1).cast("long").alias("__tl_mask"), "__tl_fp")
    masks, found, used = [2**64 - 1], None, []
    while True:
        routed = materialise(_route(todo, distance, masks), "nodes")
        used.append(routed)
        masks = sorted({m & ~b for m in masks for b in _block_masks(m, distance + 1)})
        sizes = routed.groupBy("__tl_path").agg(F.count("*").alias("__tl_n")).filter("__tl_n > 1")
        sized = routed.join(sizes, "__tl_path")
        splits = (F.col("__tl_n") > node_rows) & (F.bit_count("__tl_mask") > distance + 1)
        ready = _by_task(sized.filter(~splits).select("__tl_path", "__tl_fp"))
        done = materialise(ready.mapInArrow(_link_nodes(distance), "u long, v long"), "found")
        found = done if found is None else found.unionAll(done)
        todo = sized.filter(splits).select("__tl_path", "__tl_mask", "__tl_fp")
        if todo.isEmpty():
            break
    drop(*used)
    return found


# ---------------------------------------------------------------- operator


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``(doc id, fingerprint hex, component_id)`` for every row.

    Components are the transitive closure of links; ``component_id`` is their
    smallest id. Rows of one fingerprint are always linked, empty texts (all
    fingerprint zero) included. Null ids are carried and ignored by the minimum;
    repeated rows give repeated results; an empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, words), "simhash")
    return _label(prints, distance).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _label(prints: DataFrame, distance: int) -> DataFrame:
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "distinct")
    edges = links(distinct.select(F.col("fp").alias("__tl_fp")), distance)
    comp = components(edges)
    labelled = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "n", "first_id", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = materialise(labelled.join(least, "component").select("fp", "n", "component_id"), "labels")
    drop(distinct)
    # At most 1 / HOT_SHARE fingerprints; their rows stay where they are.
    rows = by_fp.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = by_fp.filter(F.col("n") > rows * HOT_SHARE)
    return split_join(prints, by_fp.select("fp", "component_id"), "fp", hot)


# ---------------------------------------------------------------- similarity thresholds


TOKENS = "__tl_token long, __tl_row long, __tl_class long, __tl_n long"


def _shingle_sets(words: int, exploded: bool):
    """Distinct shingle hashes of each row, ascending; texts without words have the one shingle 0.

    ``exploded``: a row for each shingle with the row's class and number of shingles, else one row with all.
    """

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in batches_by_bytes(batch, "text", SET_BYTES):
                hashes, counts = shingle_hashes(*clean_words(part.column("text"), FOLD_AZ), words)
                at = np.concatenate(([0], np.cumsum(counts)))
                sets = [np.unique(hashes[a:z]) if z > a else np.zeros(1, np.uint64) for a, z in zip(at, at[1:])]
                sizes = np.array([len(x) for x in sets])
                if not exploded:
                    data = pa.array([x.tobytes() for x in sets], pa.binary())
                    kept = [part.column(k) for k in ("__tl_group", "__tl_row", "__tl_v")]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes), data], SET_NAMES)
                    continue
                row, of = (np.repeat(part.column(c).to_numpy(), sizes) for c in ("__tl_row", "__tl_class"))
                flat, sizes = np.concatenate(sets).view(np.int64), np.repeat(sizes, sizes)
                for k in range(0, len(row), 65_536):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[k : k + 65_536]) for x in (flat, row, of, sizes)], ["__tl_token", "__tl_row", "__tl_class", "__tl_n"]
                    )

    return stage


def _hot_shingles(rows: DataFrame, words: int) -> DataFrame:
    """Shingles that very many rows share, as a sample tells."""
    n = rows.count()
    every = max(1, n // HOT_SAMPLE)
    some = rows.filter(F.pmod(F.xxhash64("__tl_row", F.lit("sample")), F.lit(every)) == 0)
    tokens = some.select("__tl_row", F.lit(0).cast("long").alias("__tl_class"), "text").mapInArrow(_shingle_sets(words, True), TOKENS)
    counts = tokens.groupBy("__tl_token").count()
    return materialise(counts.filter(F.col("count") > max(HOT_LEAST, HOT_SHINGLE * n / every)).select("__tl_token"), "hot")


def _groups(rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """``(node, component)``: groups of ``rows(__tl_row, text)`` such that similar rows share a group.

    The index makes the first classes, of fingerprints that links join. In one order of all shingles, two sets of
    similarity s share a shingle among the first n - ceil(s * n) + 1 of each (n its size). The order here
    begins with the shingles of one class only, which no pair across classes shares, so a row that has enough of
    those is like none outside its class; the others follow by document frequency. Hot shingles
    come last; their rows are never in one task.
    """
    prints = materialise(fingerprints(rows, "__tl_row", "text").distinct(), "simhash")
    labels = _label(prints, MAX_DISTANCE).select(F.col("id").alias("__tl_row"), F.col("component_id").alias("__tl_class"))
    classes = materialise(labels.filter("__tl_row <> __tl_class").distinct(), "near")
    drop(prints)
    # A class's least row and rows alone are their own class: 0 here, so that the shuffled column is short.
    heads = classes.select(F.col("__tl_class").alias("__tl_row")).distinct()
    members = classes.unionAll(heads.select("__tl_row", F.col("__tl_row").alias("__tl_class")))
    hot = _hot_shingles(rows, words)
    classed = rows.join(members, "__tl_row", "left").select("__tl_row", F.coalesce("__tl_class", F.lit(0)).alias("__tl_class"), "text")
    tokens = classed.mapInArrow(_shingle_sets(words, True), TOKENS)
    tokens = tokens.join(F.broadcast(hot.withColumn("__tl_hot", F.lit(True))), "__tl_token", "left")
    salt = F.pmod(F.xxhash64("__tl_row"), F.lit(SALTS)).cast("int")
    spread = Window.partitionBy("__tl_token", "__tl_salt")
    tokens = tokens.withColumn("__tl_salt", F.when(F.col("__tl_hot"), salt).otherwise(-1))
    df = F.when(F.col("__tl_hot"), F.lit(HOT_RANK)).otherwise(F.count("*").over(spread))
    of = F.when(F.col("__tl_class") == 0, F.col("__tl_row")).otherwise(F.col("__tl_class"))
    across = F.col("__tl_hot").isNotNull() | (F.min(of).over(spread) < F.max(of).over(spread))
    shared = tokens.withColumn("__tl_df", df).withColumn("__tl_across", across).filter("__tl_across")
    shared = shared.drop("__tl_hot", "__tl_salt", "__tl_class", "__tl_across")
    own = Window.partitionBy("__tl_row")
    shared = shared.withColumn("__tl_k", F.count("*").over(own))
    first = F.col("__tl_n") - F.ceil(similarity * F.col("__tl_n") - 1e-9) + 1
    shared = shared.filter(F.col("__tl_k") > F.col("__tl_n") - first)
    shared = shared.withColumn("__tl_at", F.row_number().over(own.orderBy("__tl_df", "__tl_token")))
    heads = shared.filter(F.col("__tl_at") <= first - F.col("__tl_n") + F.col("__tl_k"))
    heads = heads.withColumn("__tl_salt", F.when(F.col("__tl_df") == HOT_RANK, salt).otherwise(-1))
    token = F.when(F.col("__tl_salt") >= 0, F.col("__tl_token")).alias("__tl_token")
    joined = heads.select(token, F.col("__tl_row").alias("u"), F.min("__tl_row").over(spread).alias("v"))
    heads = materialise(joined.filter("u <> v OR __tl_token IS NOT NULL").distinct(), "heads")
    # The rows of a hot shingle are joined within each salt; here the salts are, at most SALTS rows a shingle.
    tops = heads.filter("__tl_token IS NOT NULL").select("__tl_token", F.col("v").alias("u")).distinct()
    tops = tops.select("u", F.min("u").over(Window.partitionBy("__tl_token")).alias("v"))
    near = classes.select(F.col("__tl_row").alias("u"), F.col("__tl_class").alias("v"))
    out = components(heads.select("u", "v").unionAll(tops).unionAll(near))
    drop(heads, hot, classes)
    return out


def link_sets(sets: list[np.ndarray], similarity: float, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of Jaccard similarity ``similarity`` or more, as index pairs.

    Sets are distinct values; ``left`` marks those of which a pair must have one (default: all).
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    heads = np.concatenate(([0], np.cumsum(sizes)))
    values, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    marked = np.zeros(len(values), np.int64)
    left = np.ones(n, bool) if left is None else left[order]
    label, out = np.arange(n), []
    for i in range(n - 1):
        # Larger sets of other trees that are small enough for the similarity.
        stop = int(np.searchsorted(sizes, sizes[i] / similarity + 1e-6, side="right"))
        rest = np.arange(i + 1, stop)
        rest = rest[(label[rest] != label[i]) & (left[rest] | left[i])]
        if not len(rest):
            continue
        counts = sizes[rest]
        starts = np.cumsum(counts) - counts
        marked[flat[heads[i] : heads[i + 1]]] = 1
        both = np.add.reduceat(marked[flat[np.arange(counts.sum()) + np.repeat(heads[rest] - starts, counts)]], starts)
        marked[flat[heads[i] : heads[i + 1]]] = 0
        for j in rest[both >= similarity * (sizes[i] + counts - both) - 1e-9].tolist():
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                out.append((int(order[i]), int(order[j])))
    return out


def _link_sets(similarity: float):
    """Tasks arrive sorted by name; emits (u, v) of linked rows."""

    def emit(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        task = pa.Table.from_batches(parts).combine_chunks()
        sets = [np.frombuffer(x, np.uint64) for x in task.column("__tl_set").to_pylist()]
        pairs = link_sets(sets, similarity, task.column("__tl_left").to_numpy())
        if not pairs:
            return None
        i, j = np.array(pairs).T
        rows, ids = task.column("__tl_row").to_numpy(), task.column("__tl_v").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows[i], rows[j], ids[i], ids[j])], ["a", "b", "u", "v"])

    return by_path(emit)


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    part_shingles: int = PART_SHINGLES,
) -> DataFrame:
    """``(doc id, component_id)`` of every document that has a similar one, itself and its class's smallest id.

    Candidates are the classes of the fingerprint index and, for pairs beyond its reach, shared rare shingles. Links: Jaccard similarity of the ``words``-word shingle sets of at least ``similarity``, exact but
    for collisions of 64-bit hashes; no similar pair is missed. Components are transitive.
    Ids are whole numbers; rows with one id are one document; rows with null ids are in no
    class. Texts without words are all alike. Empty tables give empty results.

    Groups of more than ``part_shingles`` shingles are dealt into parts. Each part is linked with the
    group's first rows; after that only rows outside the group's largest class meet all parts.
    """
    slim = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("__tl_v"), text_or_empty(text_col).alias("text"))
    rows = slim.withColumn("__tl_row", F.xxhash64("__tl_v", "text"))
    groups = _groups(rows, words, similarity).select(F.col("node").alias("__tl_row"), F.col("component").alias("__tl_group"))
    grouped = rows.join(groups, "__tl_row").select("__tl_group", "__tl_row", "__tl_v", "text").distinct()
    sets = materialise(grouped.mapInArrow(_shingle_sets(words, False), SET), "sets")
    sized = sets.groupBy("__tl_group").agg(F.ceil(F.sum("__tl_n") / part_shingles).cast("int").alias("__tl_parts"))
    sets = sets.join(sized, "__tl_group").withColumn("__tl_part", F.pmod(F.xxhash64("__tl_row"), F.col("__tl_parts")).cast("int"))
    name = lambda *parts: F.concat_ws("/", F.col("__tl_group").cast("string"), *[p.cast("string") for p in parts])

    def linked(tasks: DataFrame) -> DataFrame:
        tasks = tasks.select("__tl_path", "__tl_left", "__tl_row", "__tl_v", "__tl_set")
        return _by_task(tasks).mapInArrow(_link_sets(similarity), LINK)

    every = F.sequence(F.lit(0), F.col("__tl_parts") - 1)
    within = sets.withColumn("__tl_path", name(F.col("__tl_part"))).withColumn("__tl_left", F.lit(True))
    large = sets.filter("__tl_parts > 1")
    hubs = large.select("__tl_group", "__tl_row").withColumn("__tl_r", F.row_number().over(Window.partitionBy("__tl_group").orderBy("__tl_row")))
    hubs = hubs.filter(F.col("__tl_r") <= HUBS).select("__tl_group", "__tl_row")
    sent = large.join(hubs, ["__tl_group", "__tl_row"]).withColumn("__tl_to", F.explode(every)).filter("__tl_to <> __tl_part")
    sent = sent.withColumn("__tl_path", name(F.col("__tl_to"))).withColumn("__tl_left", F.lit(True)).drop("__tl_to")
    edges = materialise(linked(within.unionByName(sent)), "links")
    if not large.isEmpty():
        edges = edges.unionAll(_across(large, edges, name, linked, part_shingles))
    classes = components(edges.select("u", "v"))
    out = materialise(classes.select(F.col("node").alias(id_col), F.col("component").alias("component_id")), "classes")
    drop(sets)
    return out


def _across(large: DataFrame, edges: DataFrame, name, linked, part_shingles: int) -> DataFrame:
    """Links of rows outside their group's largest class with all rows of the group."""
    classes = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    classed = large.select("__tl_group", "__tl_row", "__tl_n").join(classes.withColumnRenamed("node", "__tl_row"), "__tl_row", "left")
    classed = classed.withColumn("component", F.coalesce("component", "__tl_row"))
    sizes = classed.groupBy("__tl_group", "component").agg(F.sum("__tl_n").alias("n"))
    most = sizes.groupBy("__tl_group").agg(F.max_by("component", F.struct("n", "component")).alias("__tl_most"))
    out = materialise(classed.join(most, "__tl_group").filter("component <> __tl_most").select("__tl_group", "__tl_row", "__tl_n"), "others")
    counts = out.groupBy("__tl_group").agg(F.ceil(F.sum("__tl_n") / part_shingles).cast("int").alias("__tl_outs"))
    out = out.select("__tl_row", F.lit(True).alias("__tl_left"))
    every = large.join(counts, "__tl_group").join(out, "__tl_row", "left").withColumn("__tl_left", F.coalesce("__tl_left", F.lit(False)))
    mine = F.pmod(F.xxhash64("__tl_row", F.lit("out")), F.col("__tl_outs")).cast("int")
    parts, outs = F.sequence(F.lit(0), F.col("__tl_parts") - 1), F.sequence(F.lit(0), F.col("__tl_outs") - 1)
    # Rows outside go to all parts as the left side of their share, all rows to all shares as the right one.
    a = every.filter("__tl_left").withColumn("__tl_to", F.explode(parts)).withColumn("__tl_path", name(F.col("__tl_to"), mine))
    b = every.withColumn("__tl_to", F.explode(outs)).filter(~F.col("__tl_left") | (F.col("__tl_to") != mine))
    b = b.withColumn("__tl_path", name(F.col("__tl_part"), F.col("__tl_to"))).withColumn("__tl_left", F.lit(False))
    return materialise(linked(a.unionByName(b)), "across")


def drop_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """``docs`` without those of :func:`similar_documents` that are not their class's smallest id.

    Rows that repeat an id stay or go together; rows with null ids stay.
    """
    classes = similar_documents(docs, id_col, text_col, words, similarity)
    gone = materialise(classes.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__tl_gone")), "gone")
    drop(classes)
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("__tl_gone"), "left_anti")
