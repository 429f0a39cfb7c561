"""Toxicity by weak supervision.

Voters look at a text: words of a lexicon, words found to be typical of rows
labelled toxic, word beginnings that toxic rows repeat, and patterns. Inflected
forms of one stem are each too rare to vote as words; a beginning of 4 to 6
letters votes where it comes twice or more and makes up a stated share of the
words, since clean texts hold such a stem by chance once. A generative model
with a hidden class explains their votes over all documents. Voters that fire
together within a class (insults of one language do) are no independent
witnesses, and their common silence is none either: groups of correlated voters
make hidden kinds of texts inside each class, within which voters are taken as
independent. Expectation-maximisation estimates the share of every kind and how
often each voter fires in it. The posterior of the class is the label that a
linear classifier over words and votes is trained on; the classifier scores
every text.

Votes of a text are one bit mask; documents with equal masks are counted
together, and the model is fitted on the counts, as Spark jobs that return
sums of a size given by the number of voters alone.

Labels are read only from rows that are not held out. At most about
`labelled_rows` of them, chosen by a hash of the id, are used to find typical
words and beginnings, to start the model, and to train the classifier. Label, language, source
and id are never inputs of a score. Null and empty texts have no votes and get
the score of a text without any word. Rows repeated in `labels` count once, as
toxic if any says so. A null id is never learned from and is not held out; an
empty table gives no rows. Without any label the lexicon and the patterns vote alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Stored, discard, map_batches, utf8, values

# Common insults of the languages at hand, by kind.
LEXICON = {
    "insult": ("idiot", "moron", "loser", "fool", "clown", "dumb", "scum", "imbecile", "cretin", "jerk"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "trash", "garbage", "ugly", "filthy", "vile"),
    "threat": ("kill", "hurt", "destroy", "hate"),
    "spanish": ("idiota", "estúpido", "estúpida", "basura", "asqueroso", "imbécil", "patético", "inútil"),
    "french": ("idiote", "stupide", "ordure", "dégoûtant", "imbécile", "pathétique", "minable", "crétin"),
    "german": ("dumm", "abschaum", "widerlich", "müll", "erbärmlich", "wertlos", "trottel", "versager"),
}
PATTERNS = ("insults_again", "insults_dense", "aimed", "shouting", "exclaiming")
_WORDS = re.compile(r"\w+")
_AIMED = re.compile(r"\b(?:you|your|du|dein|tu|tes|eres)\W+(?:\w+\W+){0,2}(?:%s)\b" % "|".join(w for k in LEXICON.values() for w in k))
_STARTS = (4, 5, 6)  # letters of a word's beginning
_SHARE = 0.003  # of a text's words, that a repeated beginning makes up at least
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


class Voters:
    """The votes of a text as a bit mask: lexicon kinds, typical words, repeated beginnings, patterns, in this order."""

    def __init__(self, typical: Sequence[str], beginnings: Sequence[str] = ()):
        self.typical, self.beginnings = tuple(typical), tuple(beginnings)
        self.names = (
            *LEXICON, *(f"word:{w}" for w in self.typical), *(f"start:{b}" for b in self.beginnings), *PATTERNS,
        )
        if len(self.names) > 63:
            raise ValueError("a vote mask holds at most 63 voters")
        self.bit_of = {w: 1 << k for k, words in enumerate(LEXICON.values()) for w in words}
        self.lexicon = frozenset(self.bit_of)
        for k, word in enumerate(self.typical):
            self.bit_of[word] = self.bit_of.get(word, 0) | 1 << (len(LEXICON) + k)
        first = len(LEXICON) + len(self.typical)
        self.bit_of_start = {b: 1 << (first + k) for k, b in enumerate(self.beginnings)}
        self.shortest = frozenset(b[: _STARTS[0]] for b in self.beginnings)
        self.first_pattern = first + len(self.beginnings)

    def votes(self, text: str, words: list[str]) -> int:
        mask = 0
        counts = Counter(words)
        known = counts.keys() & self.bit_of.keys()
        for word in known:
            mask |= self.bit_of[word]
        near = {w: counts[w] for w in counts if w[: _STARTS[0]] in self.shortest}
        for start in repeated_beginnings(near, len(words)) & self.bit_of_start.keys():
            mask |= self.bit_of_start[start]
        times = sum(counts[word] for word in known)
        signs = (
            times >= 2, times >= 2 and 100 * times >= 2 * len(words),
            bool(known & self.lexicon) and _AIMED.search(text.lower()) is not None,
            len(_SHOUT.findall(text)) >= 3, "!!" in text,
        )
        return mask | sum(1 << (self.first_pattern + k) for k, sign in enumerate(signs) if sign)


def repeated_beginnings(counts: dict[str, int], n_words: int) -> set[str]:
    """Word beginnings that come twice or more and are at least a share `_SHARE` of a text's words."""
    if not counts:
        return set()
    found: Counter = Counter()
    for word, n in counts.items():
        for letters in _STARTS:
            if len(word) >= letters:
                found[word[:letters]] += n
    least = max(2, math.ceil(_SHARE * n_words))
    return {start for start, n in found.items() if n >= least}


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


@dataclass
class LabelModel:
    """Kinds of texts: `toxic[k]` is a kind's class, `share[k]` its share of texts, `fires[k, j]` how often voter j fires in it."""

    toxic: np.ndarray
    share: np.ndarray
    fires: np.ndarray

    def kinds(self, votes: np.ndarray) -> np.ndarray:
        """The probability of every kind, a row for each row of votes."""
        p = np.clip(self.fires, 1e-6, 1 - 1e-6)
        each = np.log(np.maximum(self.share, 1e-12)) + votes @ np.log(p).T + (1 - votes) @ np.log(1 - p).T
        each = np.exp(each - each.max(axis=1, keepdims=True))
        return each / each.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return np.clip(self.kinds(votes) @ self.toxic, 1e-9, 1 - 1e-9)


def bits(masks: np.ndarray, n: int) -> np.ndarray:
    return ((masks[:, None] >> np.arange(n)) & 1).astype(np.float64)


def _sums(model: LabelModel):
    """For each kind: documents, then firings of each voter, as `(at, value)` rows."""
    n_kinds, n_voters = model.fires.shape

    def run(frames):
        total = np.zeros((n_kinds, n_voters + 1))
        for frame in frames:
            votes = bits(frame["mask"].to_numpy(), n_voters)
            wide = np.hstack([np.ones((len(votes), 1)), votes])
            total += (model.kinds(votes) * frame["n"].to_numpy()[:, None]).T @ wide
        yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

    return run


def fit_label_model(masks: DataFrame, start: LabelModel, anchor: float = 1.0, rounds: int = 6) -> LabelModel:
    """Expectation-maximisation over `masks(mask, n)`; the start counts as `anchor` times all documents, at every size."""
    n_kinds, n_voters = start.fires.shape
    model = start
    for _ in range(rounds):
        rows = masks.mapInPandas(_sums(model), "at int, value double").groupBy("at").agg(F.sum("value").alias("v"))
        total = np.zeros(n_kinds * (n_voters + 1))
        for r in rows.collect():  # a number for each kind and voter
            total[r.at] = r.v
        total = total.reshape(n_kinds, n_voters + 1)
        n = total[:, 0].sum()
        if not n:
            return model
        held = anchor * n * start.share
        fires = (total[:, 1:] + held[:, None] * start.fires) / np.maximum(total[:, 0] + held, 1e-9)[:, None]
        model = LabelModel(start.toxic, (total[:, 0] + held) / (n + held.sum()), fires)
    return model


def correlated_groups(votes: np.ndarray, weight: np.ndarray, least: float = 0.3) -> np.ndarray:
    """The group of each voter: voters with a correlation of `least` or more are in one, also by way of others."""
    mean = weight @ votes / max(weight.sum(), 1e-9)
    centred = votes - mean
    cov = centred.T @ (centred * weight[:, None]) / max(weight.sum(), 1e-9)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    joined = cov / np.outer(spread, spread) >= least
    group = np.arange(votes.shape[1])
    for _ in group:
        smaller = np.array([min(group[j], group[joined[j]].min(initial=j)) for j in range(len(group))])
        if (smaller == group).all():
            break
        group = smaller
    return group


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, labelled_rows: int = 16_000, typical_words: int = 16,
    typical_beginnings: int = 32, vocabulary: int = 4_000,
) -> DataFrame:
    """`(doc_id, held_out, score, predicted)` of every row of `docs(doc_id, text)`; labels are `labels(doc_id, toxic)`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = _labelled(texts, labels, labelled_rows)
    voters = Voters(*_typical(sample.df, typical_words, typical_beginnings))
    n_voters = len(voters.names)

    masks = map_batches(texts.select("text"), _masks, "mask long", voters=voters)
    masks = Stored(masks.groupBy("mask").agg(F.count("*").alias("n")), "masks")
    marked = Stored(_marked(sample.df, voters), "marked")
    start = _start(marked.df, n_voters)
    model = fit_label_model(masks.df, start)
    weights, bias = _linear(marked.df, model, n_voters, vocabulary)
    discard(sample, masks, marked)

    scored = map_batches(texts, _scores, "doc_id long, score double", voters=voters, weights=weights, bias=bias)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _labelled(texts: DataFrame, labels: DataFrame, most: int) -> Stored:
    """`(toxic, text)` of about `most` labelled rows that are not held out, each text once.

    The chosen ids are at most about `most`, a parameter, so they may be broadcast.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    share = min(1.0, most / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", F.xxhash64("text").alias("th"), "text")
    rows = Stored(rows, "labelled")
    each = rows.df.groupBy("th").agg(F.min("doc_id").alias("doc_id"), F.avg("toxic").alias("share"))
    once = rows.df.select("doc_id", "th", "text").dropDuplicates(["doc_id", "th"]).join(each, ["th", "doc_id"])
    return Stored(once.select((F.col("share") >= 0.5).cast("int").alias("toxic"), "text"), "sample")


def _typical(sample: DataFrame, words: int, beginnings: int) -> tuple[list[str], list[str]]:
    """Words, and repeated beginnings, that stand mostly in rows labelled toxic, those with the most weight of evidence first.

    Of beginnings that extend each other the one with more weight is taken, of equal ones the longer.
    """
    rows = map_batches(sample, _terms, "start boolean, term string, n long, bad long")
    toxic = max(1, sample.filter("toxic = 1").count())
    counts = rows.groupBy("start", "term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    least = F.when(F.col("start"), max(3, 0.015 * toxic)).otherwise(max(3, 0.05 * toxic))
    sure = counts.filter((F.col("bad") >= least) & (F.col("bad") >= 0.6 * F.col("n")))
    sure = sure.withColumn("weight", F.col("bad") * F.log((F.col("bad") + 1) / (F.col("n") - F.col("bad") + 1)))
    order = [F.col("weight").desc(), F.length("term").desc(), F.col("term")]
    found = [r.term for r in sure.filter("not start").orderBy(*order).limit(words).collect()]
    # A chosen beginning rules out those that it extends, at most one a length less, and those that extend it.
    starts: list[str] = []
    for r in sure.filter("start").orderBy(*order).limit(40 * beginnings).collect():
        if len(starts) < beginnings and not any(r.term.startswith(s) or s.startswith(r.term) for s in starts):
            starts.append(r.term)
    return found, starts


def _terms(batches, most=100_000):
    """Texts, and toxic texts, that hold a term; counted in the task, in tables of about `most` terms."""
    n, bad = Counter(), Counter()

    def counted():
        starts, terms = zip(*n) if n else ((), ())
        return {"start": starts, "term": terms, "n": list(n.values()), "bad": [bad[key] for key in n]}

    for batch in batches:
        for toxic, text in zip(values(batch, "toxic"), utf8(batch, "text")):
            counts = Counter(words_of((text or b"").decode()))
            keys = [(False, word) for word in counts]
            keys += [(True, start) for start in repeated_beginnings(counts, counts.total())]
            n.update(keys)
            if toxic:
                bad.update(keys)
            if len(n) >= most:
                yield counted()
                n.clear()
                bad.clear()
    yield counted()


def _masks(batches, voters):
    for batch in batches:
        texts = [(t or b"").decode() for t in utf8(batch, "text")]
        yield {"mask": [voters.votes(t, words_of(t)) for t in texts]}


def _marked(sample: DataFrame, voters: Voters) -> DataFrame:
    """Labelled rows as `(toxic, mask, tokens)`: tokens are words and votes."""
    return map_batches(sample, _tokens, "toxic int, mask long, tokens array<string>", voters=voters)


def _tokens(batches, voters, most=200_000):
    """In tables of about `most` tokens."""
    names = ("toxic", "mask", "tokens")
    for batch in batches:
        rows, held = [], 0
        for toxic, text in zip(values(batch, "toxic"), utf8(batch, "text")):
            text = (text or b"").decode()
            words = words_of(text)
            mask = voters.votes(text, words)
            tokens = [*sorted(set(words)), *_vote_tokens(mask, len(voters.names))]
            rows.append((toxic, mask, tokens))
            held += len(tokens)
            if held >= most:
                yield dict(zip(names, zip(*rows)))
                rows, held = [], 0
        if rows:
            yield dict(zip(names, zip(*rows)))


def _vote_tokens(mask: int, n: int) -> list[str]:
    return [f"vote {k}" for k in range(n) if mask >> k & 1]


def _start(marked: DataFrame, n_voters: int, least_rows: int = 3) -> LabelModel:
    """Kinds of labelled rows: in each class one for every group of correlated voters, and one for rows without votes.

    A row is of the kind whose group has most of its votes. Kinds of fewer than `least_rows` rows join the one without
    votes. Firing shares are drawn towards a voter that is right more often than not.
    """
    seen = marked.groupBy("toxic", "mask").count().collect()  # at most as many as labelled rows, a parameter
    toxic, share, fires = [], [], []
    for c, guess in ((0, 0.005), (1, 0.05)):
        rows = [r for r in seen if r.toxic == c]
        votes = bits(np.array([r["mask"] for r in rows], dtype=np.int64), n_voters)
        weight = np.array([r["count"] for r in rows], dtype=float)
        group = correlated_groups(votes, weight)
        each = np.stack([votes[:, group == g].sum(axis=1) for g in range(n_voters)], axis=1)
        kind = np.where(each.any(axis=1), each.argmax(axis=1), -1)
        kind = np.where([weight[kind == k].sum() >= least_rows for k in kind], kind, -1) if len(rows) else kind
        for k in sorted({-1, *kind.tolist()}):
            mine = kind == k
            size = weight[mine].sum()
            toxic.append(float(c))
            share.append(size + (0.9, 0.1)[c])
            fires.append((weight[mine] @ votes[mine] + 4 * guess) / (size + 4))
    return LabelModel(np.array(toxic), np.array(share) / sum(share), np.array(fires))


def _linear(marked: DataFrame, model: LabelModel, n_voters: int, vocabulary: int) -> tuple[dict[str, float], float]:
    """Weights of a logistic regression over words and votes on posterior labels; a row counts for both classes by its posterior."""

    @F.pandas_udf("double")
    def posterior(masks: pd.Series) -> pd.Series:
        return pd.Series(model.posterior(bits(masks.to_numpy(), n_voters)))

    rows = Stored(marked.withColumn("p", posterior("mask")).select("tokens", "p"), "posteriors")
    if rows.df.isEmpty():
        return _lone_votes(model, n_voters)
    terms = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=vocabulary, minDF=5, binary=True)
    terms = terms.fit(rows.df)
    if not terms.vocabulary:
        return _lone_votes(model, n_voters)
    vectors = terms.transform(rows.df)
    both = vectors.select("features", F.lit(1.0).alias("label"), F.col("p").alias("w")).unionByName(
        vectors.select("features", F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w"))
    )
    kept = Stored(both.filter("w > 1e-4"), "training")
    fit = LogisticRegression(regParam=3e-5, maxIter=60, weightCol="w", standardization=False).fit(kept.df)
    weights = dict(zip(terms.vocabulary, fit.coefficients.toArray().tolist()))
    discard(rows, kept)
    return weights, float(fit.intercept)


def _lone_votes(model: LabelModel, n_voters: int) -> tuple[dict[str, float], float]:
    """Weights where nothing can be trained: the log odds of a text without votes, and what each vote alone adds."""
    p = model.posterior(np.vstack([np.zeros((1, n_voters)), np.eye(n_voters)]))
    logit = np.log(p / (1 - p))
    return {f"vote {k}": float(logit[k + 1] - logit[0]) for k in range(n_voters)}, float(logit[0])


def _scores(batches, voters, weights, bias):
    for batch in batches:
        scores = []
        for text in utf8(batch, "text"):
            text = (text or b"").decode()
            words = words_of(text)
            total = bias + sum(weights[w] for w in set(words) & weights.keys())
            total += sum(weights.get(t, 0.0) for t in _vote_tokens(voters.votes(text, words), len(voters.names)))
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
        yield {"doc_id": values(batch, "doc_id"), "score": scores}
