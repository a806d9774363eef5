"""Quality classifier from weak labels.

Heuristic labellers vote on each document: *reject*, *accept*, or nothing.  For two
traits, low quality and toxicity, expectation-maximisation estimates how often each
labeller is right, from the counts of all vote patterns in the corpus; no truth is
needed.  Given labels, where there are any, are one more labeller.  The posterior of a
document's votes then is the label from which a hashed linear scorer is trained, and
the scorer judges every document.

Labellers of low quality look at the text's form (marks, capitals, tables, repeated
words, few different words).  Labellers of toxicity look for words and word stems that
are induced from labelled documents: strings that hardly occur in clean ones, and stems
of which clean documents hardly have two different words.

Bounds: lexicon and scorer are fitted on at most ``sample_rows`` labelled documents of at
most ``SAMPLE_BYTES`` bytes each (taken by a hash of ``doc_id``; near copies among them
count once).  Vote patterns are counted over all documents; there are at most 3 to the
power of the labellers.

Defined cases: a null or empty text gets no reject vote from its form and is scored
like any other; documents without labels are scored; with no labels at all toxicity is
never found; repeated label rows take the largest values; of several texts under one
``doc_id`` the fit takes the smallest; very long texts are scored whole; other columns,
whatever their names, are kept by ``keep_good`` and ignored by ``score_documents``; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import return_memory

#: Most labelled rows to fit on, most bytes of one of their texts, dimensions of the scorer, letters of a stem.
SAMPLE_ROWS, SAMPLE_BYTES, DIMENSIONS, STEMS = 6000, 1 << 17, 1 << 18, (3, 4, 5, 7)

_WORDS = re.compile(r"[^\W\d_]+")
_SHAPES = 6

ABSTAIN, ACCEPT, REJECT = 0, 1, 2


def shape(text: str, tokens: list[str]) -> list[float]:
    """Shares of marks, capitals, table bars, repeated neighbours, different words, and long words without a mark."""
    n, m = max(1, len(text)), max(1, len(tokens))
    marks = sum(map(text.count, "%&$*#@^~=<>{}[]\\+_"))
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    lower = text.lower()
    low = np.frombuffer(lower.encode("utf-32-le", "replace"), "<u4") if len(lower) == len(text) else codes
    letters = int(((codes >= 0xC0) | ((codes | 32) - 97 < 26)).sum())
    upper = int((codes != low).sum())
    runs = sum(map(str.__eq__, tokens, tokens[1:]))
    ends = sum(map(text.count, ".?!;:,"))
    return [marks / n, upper / max(1, letters), text.count("|") / m, runs / m, len(set(tokens)) / m if m > 80 else 1.0, ends / m]


def form_votes(text: str) -> tuple[list[int], list[float]]:
    """Votes on quality by form, and the shares they rest on."""
    tokens = text.split()
    s = shape(text, tokens)
    votes = [
        REJECT if s[0] > 0.08 else ABSTAIN,
        REJECT if s[1] > 0.4 and len(text) >= 40 else ABSTAIN,
        REJECT if s[2] > 0.2 and len(tokens) >= 2 else ABSTAIN,
        REJECT if s[3] > 0.25 else ABSTAIN,
        REJECT if s[4] < 0.2 else ABSTAIN,
        ACCEPT if s[0] < 0.02 and s[1] < 0.25 and s[2] < 0.05 and s[3] < 0.1 else ABSTAIN,
        ACCEPT if 0.02 < s[5] < 0.5 and s[2] < 0.05 and s[1] < 0.4 and s[0] < 0.05 else ABSTAIN,
    ]
    return votes, s


#: Labellers of toxicity.  One a family: lists that fall silent together would outvote the one that speaks.
LEXICAL = ("words", "stems", "stems twice")
FORM = ("marks", "capitals", "bars", "runs", "few words", "plain", "sentences")


def strings_of(text: str) -> tuple[set[str], list[set[str]]]:
    """Different words, lower-cased, and their stems of each length (only of longer words)."""
    words = set(_WORDS.findall(text.lower()))
    return words, [{w[:k] for w in words if len(w) > k} for k in STEMS]


def repeats(words: set[str]) -> int:
    """Different words of one stem that are more than chance: two, and one more for every 200 different words."""
    return 2 + len(words) // 200


@dataclass
class Lexicon:
    """Words and stems that mark toxic documents, and stems that do so by two different words."""

    words: frozenset[str] = frozenset()
    stems: tuple[frozenset[str], ...] = field(default_factory=lambda: tuple(frozenset() for _ in STEMS))
    twice: tuple[frozenset[str], ...] = field(default_factory=lambda: tuple(frozenset() for _ in STEMS))

    def found_twice(self, words: set[str], stems: list[set[str]]) -> list[str]:
        """The stems of ``twice`` that ``repeats`` different words have."""
        out, least = [], repeats(words)
        for k, own, known in zip(STEMS, stems, self.twice, strict=True):
            out += [s for s in sorted(own & known) if sum(len(w) > k and w.startswith(s) for w in words) >= least]
        return out

    def votes(self, words: set[str], stems: list[set[str]]) -> list[int]:
        if not self.words and not any(self.stems) and not any(self.twice):
            return [ABSTAIN] * len(LEXICAL)
        hits = [len(words & self.words), max(len(a & b) for a, b in zip(stems, self.stems, strict=True))]
        return [*(REJECT if h >= 2 else ABSTAIN if h else ACCEPT for h in hits), REJECT if self.found_twice(words, stems) else ACCEPT]


def induce(rows: list[tuple[str, int]], least: int = 8, share: float = 0.9) -> Lexicon:
    """Strings of at least ``least`` toxic documents (and a hundredth of them) that occur in few others; stems alike by their documents with two different words."""
    toxic = sum(t for _, t in rows)
    need = max(least, toxic // 100)
    counts, bad = [[Counter() for _ in range(1 + 2 * len(STEMS))] for _ in range(2)]
    for text, t in rows:
        words, stems = strings_of(text)
        pairs = [[s for s, n in Counter(w[:k] for w in words if len(w) > k).items() if n >= repeats(words)] for k in STEMS]
        for i, found in enumerate((words, *stems, *pairs)):
            counts[i].update(found)
            if t:
                bad[i].update(found)
    kept = [frozenset(w for w, n in b.items() if n >= need and n >= share * c[w]) for b, c in zip(bad, counts, strict=True)]
    return Lexicon(kept[0], tuple(kept[1 : 1 + len(STEMS)]), tuple(kept[1 + len(STEMS) :]))


def one_of_copies(rows: list[tuple]) -> list[tuple]:
    """Rows whose text shares none of three minima of word 5-gram hashes with an earlier one's."""
    seen: set[tuple[int, int]] = set()
    out = []
    for row in rows:
        words = row[0].lower().split()
        grams = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        keys = {(s, min(xxhash.xxh64_intdigest(g, s) for g in grams)) for s in range(3)}
        if not keys & seen:
            out.append(row)
        seen |= keys
    return out


def expectation_maximisation(patterns: dict[tuple[int, ...], int], accuracy: list[float], prior: float = 0.15, rounds: int = 50) -> tuple[float, np.ndarray]:
    """Dawid-Skene over vote patterns and their counts: share of rejects, and P(vote | class) as [labeller, class, vote].

    ``accuracy`` starts each labeller; classes are 0 (accept) and 1 (reject).  A missing vote is an outcome like another.
    """
    votes = np.array(list(patterns), np.int64)
    count = np.array(list(patterns.values()), float)
    n = votes.shape[1]
    table = np.empty((n, 2, 3))
    for j, a in enumerate(accuracy):
        seen = np.array([count[votes[:, j] == v].sum() for v in range(3)]) / count.sum()
        table[j, 0] = table[j, 1] = np.maximum(seen, 1e-3)
        table[j, 0, REJECT] *= 1 - a
        table[j, 1, REJECT] *= a
        table[j, 0, ACCEPT] *= a
        table[j, 1, ACCEPT] *= 1 - a
    table /= table.sum(axis=2, keepdims=True)
    for _ in range(rounds):
        post = posterior(votes, prior, table)
        weight = np.stack(((1 - post) * count, post * count))
        prior = float(np.clip(weight[1].sum() / count.sum(), 1e-4, 0.5))
        for j in range(n):
            for v in range(3):
                table[j, :, v] = weight[:, votes[:, j] == v].sum(axis=1) + 0.5 * (1 + (v == ABSTAIN))
        table /= table.sum(axis=2, keepdims=True)
    return prior, table


def posterior(votes: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """P(reject | votes) for each row of votes."""
    ll = np.log(table)
    j = np.arange(votes.shape[1])
    odds = np.log(prior) - np.log(1 - prior) + (ll[j, 1, votes] - ll[j, 0, votes]).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def features(text: str, lexicon: Lexicon, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed features that a document has: binned shares, votes, words and stems, each once."""
    votes, s = form_votes(text)
    words, stems = strings_of(text)
    votes = [*votes, *lexicon.votes(words, stems)]
    names = [f"\0{i}:{min(20, int(x * 40))}" for i, x in enumerate(s)]
    names += [f"\1{i}:{v}" for i, v in enumerate(votes)]
    names += [f"\2{s}" for s in lexicon.found_twice(words, stems)]
    crc = zlib.crc32
    h = [crc(w.encode()) for w in names]
    h += [crc(w.encode()) for w in words]
    for k, found in zip(STEMS, stems, strict=True):
        h += [crc(w.encode(), k) for w in found]
    return np.unique(np.array(h, np.int64) % dimensions)


def train(rows: list[np.ndarray], target: np.ndarray, dimensions: int = DIMENSIONS, rounds: int = 120, rate: float = 0.3, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch AdaGrad; both classes weigh the same.

    Only features that go with either class beyond chance (five standard deviations) have a weight;
    the many rare ones would fit the sample by heart.
    """
    w, b, grad2, gb = np.zeros(dimensions), 0.0, np.full(dimensions, 1e-6), 1e-6
    if not len(rows) or target.sum() < 1e-3:
        return w, -20.0
    size = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    share = float(np.clip(target.mean(), 1e-6, 1 - 1e-6))
    seen = np.bincount(flat, minlength=dimensions)
    z = (np.bincount(flat, np.repeat(target, size), dimensions) - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    chosen = (np.abs(z) > 5)[flat]
    owner = np.repeat(np.arange(len(rows)), size)[chosen]
    flat = flat[chosen]
    weight = target / max(target.sum(), 1e-9) + (1 - target) / max((1 - target).sum(), 1e-9)
    weight /= weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[flat], len(rows)) + b, -30, 30)))
        err = (p - target) * weight
        g = np.bincount(flat, err[owner], dimensions) + decay * w / len(rows)
        grad2 += g * g
        gb += err.sum() ** 2
        w -= rate * g / np.sqrt(grad2)
        b -= rate * err.sum() / np.sqrt(gb)
    return w, b


@dataclass
class Model:
    lexicon: Lexicon
    accuracies: dict[str, tuple[float, float]]
    quality: tuple[np.ndarray, float]
    toxic: tuple[np.ndarray, float]

    def scores(self, text: str) -> tuple[float, float]:
        """P(low quality), P(toxic) by the linear scorers."""
        x = features(text, self.lexicon, len(self.quality[0]))
        return tuple(float(1 / (1 + np.exp(-np.clip(w[x].sum() + b, -30, 30)))) for w, b in (self.quality, self.toxic))


def _labelled(docs: DataFrame, labels: DataFrame, rows: int) -> list[tuple[str, int, int]]:
    """At most ``rows`` labelled documents, those of the smallest hashes of their ``doc_id``; the label side is broadcast, it has that bound."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    one = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.where(F.octet_length("text") <= SAMPLE_BYTES)
    got = own.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    out: dict[int, tuple[str, int, int]] = {}
    for d, text, q, t in got.toLocalIterator():
        if d not in out or text < out[d][0]:
            out[d] = text, q, t
    return [out[d] for d in sorted(out)]


_VOTERS = len(FORM)


def _voter(lexicon: Lexicon):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                found["q" + "".join(map(str, form_votes(text)[0]))] += 1
                found["t" + "".join(map(str, lexicon.votes(*strings_of(text))))] += 1
        yield pa.RecordBatch.from_pydict({"votes": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    return work


def fit(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> Model:
    """Labellers' accuracies from all of ``docs``, lexicon and scorers from the labelled sample.

    Without labels the scorer is fitted on a sample of the documents of the same bound.
    """
    if labels is None or labels.isEmpty():
        n = max(1, docs.count())
        part = docs.where(F.octet_length("text") <= SAMPLE_BYTES).where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample_rows / n)) + 1)
        sample = [(t, None, 0) for (t,) in part.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_rows).select("text").collect()]
    else:
        sample = _labelled(docs, labels, sample_rows)
    sample = one_of_copies(sample)
    lexicon = induce([(text, int(t or 0)) for text, _, t in sample])
    counts = docs.select("text").mapInArrow(_voter(lexicon), "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    tables, accuracies = {}, {}
    for sign, names, start in (("q", FORM, 0.9), ("t", LEXICAL, 0.6)):
        patterns = {tuple(map(int, r["votes"][1:])): r["n"] for r in counts if r["votes"][0] == sign}
        # Given labels join as one more labeller, silent on the rest of the corpus.
        patterns = {(*v, ABSTAIN): n for v, n in patterns.items()}
        for text, q, t in sample:
            own = form_votes(text)[0] if sign == "q" else lexicon.votes(*strings_of(text))
            given = None if q is None else (1 - int(q) if sign == "q" else int(t or 0))
            if given is not None and patterns.get(key := (*own, ABSTAIN), 0) > 0:
                patterns[key] -= 1
                patterns[(*own, REJECT if given else ACCEPT)] = patterns.get((*own, REJECT if given else ACCEPT), 0) + 1
        patterns = {v: n for v, n in patterns.items() if n > 0} or {(ABSTAIN,) * (len(names) + 1): 1}
        tables[sign] = expectation_maximisation(patterns, [start] * len(names) + [0.97])
        table = tables[sign][1]
        accuracies |= {f"{'quality' if sign == 'q' else 'toxicity'}: {x}": (float(table[j, 0, ACCEPT] + table[j, 0, ABSTAIN]), float(table[j, 1, REJECT])) for j, x in enumerate((*names, "given"))}
    soft_q, soft_t, rows = [], [], []
    for text, q, t in sample:
        words, stems = strings_of(text)
        vq = [*form_votes(text)[0], ABSTAIN if q is None else ACCEPT if int(q) else REJECT]
        vt = [*lexicon.votes(words, stems), ABSTAIN if q is None else REJECT if int(t or 0) else ACCEPT]
        soft_q.append(posterior(np.array([vq]), *tables["q"])[0])
        soft_t.append(posterior(np.array([vt]), *tables["t"])[0])
        rows.append(features(text, lexicon, dimensions))
    quality = train(rows, np.array(soft_q), dimensions)
    toxic = train(rows, np.array(soft_t), dimensions) if any(lexicon.stems) or any(lexicon.twice) or lexicon.words else (np.zeros(dimensions), -20.0)
    del sample, soft_q, soft_t, rows
    return_memory()
    return Model(lexicon, accuracies, *((w.astype(np.float32), b) for w, b in (quality, toxic)))


def _scorer(model, limit: float, filtering: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            got = [fitted.scores(t.as_py() or "") for t in batch.column("text")]
            keep = pa.array([max(x) <= limit for x in got], pa.bool_())
            if filtering:
                yield batch.filter(keep)
            else:
                low, toxic = (pa.array([x[i] for x in got], pa.float64()) for i in range(2))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), low, toxic, keep], names=["doc_id", "p_low", "p_toxic", "kept"])
            pa.default_memory_pool().release_unused()

    return work


def score_documents(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """doc_id, p_low, p_toxic, kept for every row of ``docs(doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of fixed size and a lexicon bounded by the sample
    return docs.select("doc_id", "text").mapInArrow(_scorer(sent, limit, False), "doc_id long, p_low double, p_toxic double, kept boolean")


def keep_good(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the scorer accepts, with their columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scorer(sent, limit, True), docs.schema)
