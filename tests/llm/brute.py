"""Plain versions of the operators over a list of rows, to hold the Spark results against."""

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = r"[^\x20\x09-\x0D]+"


def simhash(rows):
    """{(doc_id, text): (fingerprint, component)} for rows (doc_id, text); ids are unique."""
    prints = {}
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(SPACE, low)
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(prints)
    codes = np.array([prints[d] for d in ids], dtype=np.uint64)
    for i, d in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 3).tolist():
            a, b = root(d), root(ids[j])
            parent[max(a, b)] = min(a, b)
    return {d: (f"{prints[d]:016x}", root(d)) for d in ids}


ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def token_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def pieces(ids, capacity=1024):
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]


def substring(rows, window=13):
    words = {d: re.findall(SPACE, t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def suffix(rows, length=200):
    """A list in the order of the rows; rows may repeat."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    n, again = len(words), len(repeated)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again,
        n < 10 or 100 * again > 20 * n,
    )


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        rest = total - sum(fixed.values())
        found = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if found[n] > most * sizes[n]]
        if not over:
            return fixed | found
        fixed |= {n: most * sizes[n] for n in over}


def neighbours(rows, k=10):
    """{query: [(vec_id, score)]} by comparing all; rows (vec_id, vector) take part if finite and not zero."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, data = np.array([i for i, _ in good]), np.array([v for _, v in good], dtype=np.float64)
    out = {}
    for i, v in good:
        if i % 100 == 0:
            away = np.sqrt(((data - np.array(v, dtype=np.float64)) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, away)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(away[j])) for j in order]
    return out


def alignment(rows, tokenizer, model):
    """A list of (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) in the order of the rows."""
    letters = {c: bytes([b]) for b, c in zip(range(256), _byte_letters())}
    names = {k: b"".join(letters[c] for c in t) for t, k in tokenizer.get_vocab().items() if t != "<|endoftext|>"}
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(k, names[k]) for k in tokenizer.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = []
        for k in model.encode(text) if text else []:
            piece = model.id_to_piece(k)
            b.append((k, bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("\u2581", " ").encode()))
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a = b = []
        ends = [dict(zip(np.cumsum([len(x) for _, x in side]).tolist(), side)) for side in (a, b)]
        shared = sorted(ends[0].keys() & ends[1].keys())
        links = [(ends[0][e][0], ends[1][e][0]) for e in shared]
        sides = [[[] for _ in shared] for _ in ends]
        for side, tokens in zip(sides, ends):
            for e, (k, _) in tokens.items():
                side[bisect_left(shared, e)].append(str(k))
        groups = ["|".join(",".join(side[i]) for side in sides) for i in range(len(shared))]
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(shared), links, ";".join(groups)))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, n_a, n_b, n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), _hex(g) if g else "")
        for d, n_a, n_b, n, links, g in found
    ]


def _byte_letters():
    """The characters of a byte-level vocabulary, by byte."""
    next_free, out = 256, []
    for b in range(256):
        printable = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
        out.append(chr(b if printable else next_free))
        next_free += not printable
    return out


def _hex(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    """The digest of (doc_id, source, lang, n_chars, text)."""
    return _hex("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(digests):
    """The root, and for each digest the texts to its left and right on every level."""
    paths, place = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(place):
            first = p // 16 * 16
            paths[i].append(("".join(digests[first:p]), "".join(digests[p + 1 : first + 16])))
            place[i] = p // 16
        digests = [_hex("".join(digests[a : a + 16])) for a in range(0, len(digests), 16)]
    return digests[0], paths


def manifest(rows):
    """A list of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); rows may repeat."""
    if not rows:
        return []
    by_source, trees = defaultdict(list), {}
    for row in rows:
        by_source[row[1]].append((row, leaf(row)))
    for source, leaves in by_source.items():
        leaves.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = _tree([digest for _, digest in leaves])
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, upper = _tree([trees[s][0] for s in names])
    out = []
    for source, above in zip(names, upper):
        subroot, paths = trees[source]
        for (row, digest), path in zip(by_source[source], paths):
            folded = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf((*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4])))
            for left, right in path + above:
                folded = _hex(left + folded + right)
            proof = _hex("".join(left + right for left, right in path + above))
            out.append((row[0], digest, subroot, root, proof, folded, folded == root))
    return out


def components(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            now = todo.pop()
            if now not in out:
                out[now] = start
                todo += near[now] - out.keys()
    return out
