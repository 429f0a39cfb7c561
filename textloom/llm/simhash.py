"""SimHash near-duplicates by an inverted index over the bytes of fingerprints.

Two fingerprints of B bytes that differ in at most k bits share at least B - k
bytes at their positions. Postings are by (positions, bytes): one byte alone
would list 1/256 of all fingerprints, so three positions make a posting. The
triples are chosen so that any pair with the guaranteed number of shared bytes
meets in at least one. In a posting, shared positional bytes are tallied, pairs
below the minimum dropped, and the rest verified bit by bit.

Equal fingerprints are one node. A posting of a dense group would hold pairs
without end, so only a minimum spanning forest of each posting's verified pairs
is kept: it connects the same fingerprints. Postings of more than `block`
fingerprints are cut into blocks, and every two blocks meet in one bounded
group; no member, pair or block is left out.

Null and empty texts have the fingerprint zero and are linked like any other.
Repeated rows share a fingerprint. A null id is never the smallest of a
component unless all are null. Columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ROWS_PER_OUTPUT, Stored, collect_garbage, components, discard, map_batches, utf8, values
from textloom.operators.overlap import bloom_filter

SEED = 42
HALVES = tuple(combinations(range(4), 3)) + tuple(combinations(range(4, 8), 3))
"""Five of eight positions put three in one half, so these eight triples miss no pair within three bits."""


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every `size`-word shingle of the text, repeats included."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z alone change case, and the word space is \x20 and \x09-\x0D
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n)


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """A bit is 1 if it is set in over half of the hashes; further 64-bit words are mixed from the hash."""
    out = []
    for k in range(words):
        mixed = hashes if k == 0 else mix(hashes + np.uint64(k))
        out.append(np.packbits(2 * _bit_counts(mixed) > len(hashes)).tobytes())
    return b"".join(out)


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of the splitmix64 generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    counts = np.zeros(64, dtype=np.int64)
    step = 255 * 64  # sums of 255 bits fit a byte
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[at : at + step].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255
        if whole:
            counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, shingle: int, words: int = 1, distinct: bool = False) -> DataFrame:
    """`(uid, doc_id, fp)` of `docs(uid, doc_id, text)`; store it before using it twice."""
    return map_batches(
        docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), "text"),
        _fingerprints, "uid long, doc_id long, fp binary", shingle=shingle, words=words, distinct=distinct,
    )


def _fingerprints(batches, shingle, words, distinct):
    for batch in batches:
        found = []
        for text in utf8(batch, "text"):
            hashes = shingle_hashes(text or b"", shingle)
            found.append(fingerprint(np.unique(hashes) if distinct else hashes, words))
        yield {"uid": values(batch, "uid"), "doc_id": values(batch, "doc_id"), "fp": found}


def _postings(batches, triples):
    positions = np.array(triples)
    label = np.arange(len(triples), dtype=np.int64) << 24
    for batch in batches:
        fps, nodes = values(batch, "fp"), np.array(values(batch, "node"), dtype=np.int64)
        for at in range(0, len(fps), 2000):
            part = fps[at : at + 2000]
            held = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), -1).astype(np.int64)
            three = held[:, positions]
            keys = (three[:, :, 0] << 16) + (three[:, :, 1] << 8) + three[:, :, 2] + label
            yield {"key": keys.ravel(), "node": np.repeat(nodes[at : at + 2000], len(triples))}


def near_edges(
    nodes: DataFrame, triples: Sequence[tuple[int, int, int]], n_bytes: int, most_bits: int, block: int = 2048
) -> DataFrame:
    """Edges `(a, b)` of a spanning forest of all pairs of `nodes(node, fp)` that meet in a posting and differ in at
    most `most_bits` bits. An edge may come from several postings."""
    posted = map_batches(nodes.select("node", "fp"), _postings, "key long, node long", triples=tuple(triples))
    least = max(3, n_bytes - most_bits)
    return map_batches(meetings(posted, nodes.select("node", "fp"), block), _forests, "a long, b long", n_bytes=n_bytes, most_bits=most_bits, least=least)


def meetings(posted: DataFrame, nodes: DataFrame, block: int = 2048, sizes: DataFrame | None = None) -> DataFrame:
    """The rows of `nodes(node, fp, ...)` by the postings `posted(key, node)` of two nodes or more, with the blocks
    `(i, j)` of the posting: each run of equal `(key, i, j)` is in one partition, and any two nodes of a posting meet."""
    if sizes is None:
        sizes = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    met = posted.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")
    return met.join(nodes, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def _forests(batches, n_bytes, most_bits, least):
    """Forest edges of each run of rows with the same (key, i, j); a run may go on in the next batch."""
    nodes, fps, held = [], [], None
    out = ([], [])

    def close():
        if len(nodes) > 1:
            packed = np.frombuffer(b"".join(fps), np.uint8).reshape(-1, n_bytes)
            for x, y in forest(packed, most_bits, least):
                out[0].append(nodes[x])
                out[1].append(nodes[y])

    for batch in batches:
        for key, i, j, node, fp in zip(*(values(batch, c) for c in ("key", "i", "j", "node", "fp"))):
            if (key, i, j) != held:
                close()
                nodes, fps, held = [], [], (key, i, j)
                if len(out[0]) >= ROWS_PER_OUTPUT:
                    yield {"a": out[0], "b": out[1]}
                    out = ([], [])
            nodes.append(node)
            fps.append(fp)
    close()
    if out[0]:
        yield {"a": out[0], "b": out[1]}


def forest(packed: np.ndarray, most_bits: int, least: int) -> Iterator[tuple[int, int]]:
    """Edges of a minimum spanning forest of the rows of `packed`: pairs with `least` shared bytes or more and at
    most `most_bits` differing bits, the nearest first."""
    far = 8 * packed.shape[1] + 1

    def distance(rest: np.ndarray, one: np.ndarray) -> np.ndarray:
        tally = (rest == one).sum(axis=1)
        bits = np.bitwise_count(rest ^ one).sum(axis=1, dtype=np.int32)
        return np.where((tally >= least) & (bits <= most_bits), bits, far)

    rest = np.arange(1, len(packed))
    near, parent = distance(packed[rest], packed[0]), np.zeros(len(rest), dtype=np.int64)
    while len(rest):
        k = int(near.argmin())
        now = int(rest[k])
        if near[k] < far:
            yield int(parent[k]), now
        keep = np.arange(len(rest)) != k
        rest, near, parent = rest[keep], near[keep], parent[keep]
        to_now = distance(packed[rest], packed[now])
        closer = to_now < near
        near, parent = np.where(closer, to_now, near), np.where(closer, now, parent)


def simhash_classes(docs: DataFrame, shingle: int = 3, most_bits: int = 3) -> DataFrame:
    """`(doc_id, fingerprint, component_id)` of `docs(doc_id, text)`, one row for each row.

    64-bit fingerprints link at `most_bits` (three or fewer) differing bits; a
    component is named by its smallest id.
    """
    if most_bits > 3:
        raise ValueError("the eight postings find all pairs within three bits")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    prints = Stored(fingerprints(rows, shingle), "fingerprints")
    nodes = prints.df.groupBy("fp").agg(F.min("uid").alias("node"), F.min("doc_id").alias("first"))
    nodes = Stored(nodes, "nodes")
    edges = Stored(near_edges(nodes.df, HALVES, 8, most_bits), "edges")
    linked = components(edges.df)
    discard(edges)
    rooted = nodes.df.join(linked.df, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.df.join(named, "fp").select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, words: int = 6) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (null last).

    Groups are connected by pairs whose sets of `shingle`-word shingles have a
    Jaccard similarity of `similarity` or more. Any such pair shares one of the
    first shingles of both sets in a fixed order (`prefix`), so postings by
    these miss no pair. Fingerprints of `words` x 64 bits over the sets say
    which pairs of a posting are looked at: those up to five standard deviations
    beyond the bits expected. The forest of a posting is verified on the texts;
    where an edge fails between two groups, all that the forests connect with
    them meet with their sets of shingles (`_alike_in_groups`), and only a forest
    of the pairs of the similarity leaves a task. Columns are those of `docs`.
    """
    n_bytes = 8 * words
    # Sets of four and five shingles that share four differ in 3/16 of the bits: small sums are often even.
    share = max(np.arccos(2 * similarity / (1 + similarity)) / np.pi, 3 / 16)
    most_bits = int(8 * n_bytes * share + 5 * np.sqrt(8 * n_bytes * share * (1 - share)))
    kept = Stored(docs.select(F.monotonically_increasing_id().alias("__uid"), *docs.columns), "documents")
    rows = kept.df.select(F.col("__uid").alias("uid"), "doc_id", "text")
    prints = map_batches(
        rows.select("uid", F.col("doc_id").cast("long").alias("doc_id"), "text"), _prefixed,
        "uid long, doc_id long, fp binary, prefix array<long>",
        shingle=shingle, words=words, similarity=similarity, common=common_shingles(rows, shingle),
    )
    whole = Stored(prints, "fingerprints")
    nodes = Stored(whole.df.groupBy("fp").agg(F.min("uid").alias("node")), "nodes")
    heads = whole.df.select(F.col("uid").alias("node"), "prefix").join(nodes.df.select("node"), "node", "left_semi")
    heads = Stored(heads, "heads")
    prints = Stored(whole.df.select("uid", "doc_id", "fp"), "prints")
    discard(whole)
    keys = shared_keys(heads.df)
    bits, held = key_filter(keys.df.select("key"))
    posted = map_batches(heads.df, _kept_postings, "key long, node long", bits=bits, held=held)
    posted = Stored(posted.join(keys.df.select("key"), "key", "left_semi"), "postings")
    discard(heads)
    form = {"n_bytes": n_bytes, "most_bits": most_bits, "least": 0}
    tree = map_batches(meetings(posted.df, nodes.df, sizes=keys.df), _forests, "a long, b long", **form)
    tree = Stored(tree.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    discard(posted, keys)
    edges = Stored(_verified(rows, tree.df, shingle, similarity), "edges")
    linked = components(edges.df)
    rooted = nodes.df.join(linked.df, "node", "left").withColumn("root", F.coalesce("root", "node"))
    failed = tree.df.join(edges.df, ["a", "b"], "left_anti")
    root_of = lambda end: rooted.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    between = failed.join(root_of("a"), "a").join(root_of("b"), "b").filter("root_a != root_b")
    between = Stored(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "roots")
    if not between.df.isEmpty():
        groups = components(between.df)
        more = _alike_in_groups(rows, rooted, groups.df, shingle, similarity, n_bytes, most_bits)
        more = Stored(more.distinct(), "edges")
        discard(linked, groups)
        linked = components(edges.df.unionByName(more.df))
        discard(more)
    discard(tree, edges, between)
    # Every row has a place in its group: equal fingerprints are one node, nodes are joined by edges.
    rooted = nodes.df.join(linked.df, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
    members = prints.df.join(rooted, "fp").select("root", "uid", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"))
    least = members.groupBy("root").agg(F.min("id").alias("least"))
    first = members.join(least, "root").filter("id = least").groupBy("root").agg(F.min("uid").alias("__uid"))
    return kept.df.join(first.select("__uid"), "__uid", "left_semi").select(*docs.columns)


def shared_keys(heads: DataFrame, passes: int = 4) -> Stored:
    """`(key, n)`: the keys of `heads(node, prefix)` that two nodes or more share, one for each set of n nodes.

    Near copies share many shingles and so meet in many postings of the same nodes; one of them is enough. Sets are
    told apart by their size, their smallest node and an exclusive or of hashes. Each pass counts its part of the keys, so
    that no more than that part is shuffled at a time.
    """
    parts = []
    for k in range(passes):
        own = F.filter("prefix", lambda key: F.pmod(key, F.lit(passes)) == k)
        counted = heads.select("node", F.explode(own).alias("key")).groupBy("key").agg(
            F.count("*").alias("n"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("mark")
        )
        each = counted.filter("n > 1").groupBy("n", "low", "mark").agg(F.min("key").alias("key"))
        parts.append(Stored(each, "keys"))
        collect_garbage(heads.sparkSession)
    union = parts[0].df
    for part in parts[1:]:
        union = union.unionByName(part.df)
    found = Stored(union.groupBy("n", "low", "mark").agg(F.min("key").alias("key")).select("key", "n"), "keys")
    discard(*parts)
    return found


def key_filter(keys: DataFrame, most: int = 1 << 27) -> tuple[int, Broadcast]:
    """A Bloom filter of `keys(key)`, which are hashes: two places of each, in at most `most` bits whatever their number.

    What it lets through by chance is dropped by the join that follows.
    """
    bits = 1 << max(15, min(most, 16 * keys.count()).bit_length() - 1)
    places = F.array(F.col("key").bitwiseAND(F.lit(bits - 1)), F.shiftright("key", 27).bitwiseAND(F.lit(bits - 1)))
    held = bloom_filter(keys.select(F.explode(places).alias("place")), bits)
    return bits, keys.sparkSession.sparkContext.broadcast(held)


def _let_through(hashes: np.ndarray, bits: int, held: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), dtype=bool)
    for places in (hashes & (bits - 1), (hashes >> 27) & (bits - 1)):
        found &= ((held[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool)
    return found


def _kept_postings(batches, bits, held):
    for batch in batches:
        prefixes = batch.column(batch.schema.get_field_index("prefix"))
        sizes = prefixes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        keys = prefixes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        nodes = np.repeat(np.array(values(batch, "node"), dtype=np.int64), sizes)
        kept = _let_through(keys, bits, held.value)
        yield {"key": keys[kept], "node": nodes[kept]}


def _verified(rows: DataFrame, near: DataFrame, shingle: int, similarity: float, salts: int = 64) -> DataFrame:
    """The pairs of `near(a, b)` whose texts have the similarity; pairs are unique.

    Only texts of pairs leave their task. The texts of all b of an a come after that of a, one at a time; the pairs of one a
    are dealt over `salts` runs.
    """
    near = Stored(near, "pairs")
    salted = near.df.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    seconds = salted.select(F.col("b").alias("uid"), "a", "salt", "b")
    firsts = salted.select(F.col("a").alias("uid"), "a", "salt", F.lit(-1).cast("long").alias("b")).distinct()
    ends = firsts.unionByName(seconds)
    bits, held = key_filter(ends.select(F.xxhash64("uid").alias("key")).distinct())
    texts = map_batches(rows.select("uid", F.xxhash64("uid").alias("h"), "text"), _texts_asked, "uid long, text string", bits=bits, held=held)
    met = texts.join(ends, "uid").select("a", "salt", "b", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
    return map_batches(met, _alike, "a long, b long", shingle=shingle, similarity=similarity)


def _alike_in_groups(
    rows: DataFrame, rooted: DataFrame, groups: DataFrame, shingle: int, similarity: float, n_bytes: int, most_bits: int,
    block: int = 2048, held: int = 1 << 21,
) -> DataFrame:
    """Edges `(a, b)` that connect what the pairs of the similarity connect of `rooted(node, fp, root)` inside each group of
    `groups(node, root)`, whose nodes are the roots.

    A set of shingles leaves its task once for each block of its group; blocks have about `block` nodes and `held` shingles
    at most, and every two blocks meet in one run, where the sets are compared. Nodes of one root are not compared.
    """
    grouped = rooted.join(groups.select(F.col("node").alias("root"), F.col("root").alias("part")), "root")
    bits, let = key_filter(grouped.select(F.xxhash64("node").alias("key")))
    asked = rows.select("uid", F.xxhash64("uid").alias("h"), "text")
    sets = map_batches(asked, _sets_asked, "node long, shingles array<long>", shingle=shingle, bits=bits, held=let)
    sets = Stored(sets.join(grouped, "node").select("part", "node", "root", "fp", "shingles"), "sets")
    sizes = sets.df.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("m"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("m") / held)).cast("int")
    large = sizes.select("part", blocks.alias("blocks")).filter("blocks > 1")  # few: each has a block's worth of nodes or shingles
    met = sets.df.join(F.broadcast(large), "part", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    met = met.select("part", "i", "j", "own", "node", "root", "fp", "shingles").repartition("part", "i", "j")
    met = met.sortWithinPartitions("part", "i", "j", "node")
    return map_batches(met, _alike_forests, "a long, b long", n_bytes=n_bytes, most_bits=most_bits, similarity=similarity)


def _sets_asked(batches, shingle, bits, held):
    """Texts are chosen and cut in one worker: a step of its own for each would keep two of them for every task."""
    for batch in _asked(batches, bits, held):
        rows, n = [], 0
        for uid, text in zip(values(batch, "uid"), utf8(batch, "text")):
            rows.append((uid, np.unique(shingle_hashes(text or b"", shingle)).view(np.int64)))
            n += len(rows[-1][1])
            if n > 1 << 20:
                yield dict(zip(("node", "shingles"), zip(*rows)))
                rows, n = [], 0
        if rows:
            yield dict(zip(("node", "shingles"), zip(*rows)))


def _alike_forests(batches, n_bytes, most_bits, similarity):
    """Edges of each run of rows with the same (part, i, j): every pair of block i and block j meets, but only a forest of
    those of the similarity comes out; a run may go on in the next batch."""
    rows, run = [], None
    out = {"a": [], "b": []}

    def close():
        if len(rows) < 2:
            return
        nodes, roots, own, fps, sets = zip(*rows)
        packed = np.frombuffer(b"".join(fps), np.uint8).reshape(-1, n_bytes)
        apart = np.array(own) if run[1] != run[2] else np.arange(len(rows))
        for x, y in alike_forest(packed, np.array(roots), apart, sets, most_bits, similarity):
            out["a"].append(min(nodes[x], nodes[y]))
            out["b"].append(max(nodes[x], nodes[y]))

    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("shingles"))
        sets = np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        for part, i, j, own, node, root, fp, one in zip(*(values(batch, c) for c in ("part", "i", "j", "own", "node", "root", "fp")), sets):
            if (part, i, j) != run:
                close()
                rows, run = [], (part, i, j)
            rows.append((node, root, own, fp, one))
        if len(out["a"]) >= ROWS_PER_OUTPUT:
            yield out
            out = {"a": [], "b": []}
    close()
    yield out


def alike_forest(
    packed: np.ndarray, roots: np.ndarray, apart: np.ndarray, sets: Sequence[np.ndarray], most_bits: int, similarity: float
) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the pairs of `sets` of the similarity, roots being connected already. Only pairs with
    different values of `apart` and at most `most_bits` differing bits are compared, and none that is connected by then."""
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    label = np.unique(roots, return_inverse=True)[1]
    mark = np.zeros(int(sizes.sum()) + 1, dtype=bool)
    for k in range(len(sets) - 1):
        rest = k + 1 + np.flatnonzero((label[k + 1 :] != label[k]) & (apart[k + 1 :] != apart[k]))
        rest = rest[np.minimum(sizes[rest], sizes[k]) >= similarity * np.maximum(sizes[rest], sizes[k]) - 1e-6]
        if len(rest):
            bits = np.bitwise_count(packed[rest] ^ packed[k]).sum(axis=1, dtype=np.int32)
            rest = rest[bits <= most_bits]
        mark[codes[k]] = True
        for x in rest.tolist():
            if label[x] != label[k]:
                both = np.count_nonzero(mark[codes[x]])
                if both >= similarity * (sizes[k] + sizes[x] - both):
                    yield k, x
                    label[label == label[x]] = label[k]
        mark[codes[k]] = False


def _asked(batches, bits, held):
    for batch in batches:
        asked = _let_through(np.array(values(batch, "h"), dtype=np.int64), bits, held.value)
        some = batch.filter(pa.array(asked))
        if some.num_rows:
            yield some


def _texts_asked(batches, bits, held):
    for some in _asked(batches, bits, held):
        yield {"uid": some.column(0), "text": some.column(2)}


def _alike(batches, shingle, similarity):
    """The pairs of each run of rows (a, salt, b, text), of which the first is a's own; a run may go on in the next batch."""
    run, first = None, None
    for batch in batches:
        out = ([], [])
        for a, salt, b, text in zip(*(values(batch, c) for c in ("a", "salt", "b")), utf8(batch, "text")):
            found = np.unique(shingle_hashes(text or b"", shingle))
            if (a, salt) != run:
                run, first = (a, salt), found
                continue
            both = len(np.intersect1d(first, found, assume_unique=True))
            if both >= similarity * (len(first) + len(found) - both):
                out[0].append(a)
                out[1].append(b)
        yield {"a": out[0], "b": out[1]}


def common_shingles(rows: DataFrame, shingle: int, sample: int = 20_000, most: int = 200_000) -> np.ndarray:
    """Shingles of several texts of a bounded sample of `rows(uid, text)`, the commonest last. They only order the
    shingles, so that postings are short; any list gives the same pairs."""
    share = min(1.0, sample / max(1, rows.count()))
    some = rows.filter(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = map_batches(some.select("text"), _each_shingle, "key long", shingle=shingle)
    found = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 2")
    top = found.orderBy(F.desc("n"), "key").limit(most).select("key").collect()
    return np.array([r.key for r in top][::-1], dtype=np.int64)


def _each_shingle(batches, shingle):
    for batch in batches:
        for text in utf8(batch, "text"):
            yield {"key": np.unique(shingle_hashes(text or b"", shingle)).view(np.int64)}


def prefix(hashes: np.ndarray, ranks: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, the rare ones first: two sets of the similarity or more share one of them at least,
    as a set of n has `similarity` x n or more in common with the other."""
    if not len(hashes):
        return hashes
    keys, places = ranks
    rank = np.full(len(hashes), -1)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        rank = np.where(keys[at] == hashes, places[at], -1)
    return hashes[np.lexsort((hashes, rank))[: len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + 1]]


def _prefixed(batches, shingle, words, similarity, common):
    order = np.argsort(common)
    ranks = (common[order], order)
    for batch in batches:
        rows, held = [], 0
        for uid, doc_id, text in zip(values(batch, "uid"), values(batch, "doc_id"), utf8(batch, "text")):
            hashes = np.unique(shingle_hashes(text or b"", shingle))
            rows.append((uid, doc_id, fingerprint(hashes, words), prefix(hashes.view(np.int64), ranks, similarity)))
            held += len(rows[-1][-1])
            if held > 1 << 20:
                yield dict(zip(("uid", "doc_id", "fp", "prefix"), zip(*rows)))
                rows, held = [], 0
        if rows:
            yield dict(zip(("uid", "doc_id", "fp", "prefix"), zip(*rows)))

