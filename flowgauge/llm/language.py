"""Language identification in two steps: the family first, then one-against-one linear machines inside the family."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.ordering import top_rows

UNDETERMINED = "und"
BUCKETS = 1 << 13
# Related languages, by their usual families; a language outside the lists is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sr", "hr"),
}


def features(text: bytes) -> np.ndarray:
    """Unit vector of hashed counts of all byte pairs and triples of the whole text; zero for under two bytes."""
    counts = np.zeros(BUCKETS)
    step = 1 << 20
    for at in range(0, len(text), step):  # bounded memory for a text of any length; a part sees the two bytes before it
        b = np.frombuffer(text[max(0, at - 2) : at + step], np.uint8).astype(np.uint32)
        lead = min(at, 2)
        if len(b) - max(lead, 1) > 0:
            pairs = b[:-1] * np.uint32(256) + b[1:]
            counts += np.bincount((pairs[max(lead - 1, 0) :] * np.uint32(2654435761)) >> np.uint32(19), minlength=BUCKETS)
            triples = pairs[:-1] * np.uint32(256) + b[2:]
            counts += np.bincount((triples * np.uint32(2246822519) + np.uint32(97)) >> np.uint32(19), minlength=BUCKETS)
    norm = np.sqrt(counts @ counts)
    return counts / norm if norm else counts


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = 40, penalty: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Weights and bias of a linear support vector machine for signs y, by subgradient steps over shuffled batches."""
    order = np.random.default_rng(seed)
    w, total, t = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)  # classes count alike
    for _ in range(rounds):
        for part in np.array_split(order.permutation(len(y)), max(1, len(y) // 64)):
            t += 1
            wrong = y[part] * (x[part] @ w[:-1] + w[-1]) < 1
            push = (weight[part] * y[part])[wrong]
            grad = np.append(push @ x[part][wrong], push.sum()) / len(part)
            w = (1 - 1 / (t + 1)) * w + grad / (penalty * (t + 100))
            total += w
    return total / max(t, 1)


@dataclass(frozen=True)
class Model:
    """families: family -> its languages. machines: (first, second) -> weights; a positive side speaks for the first."""

    families: Mapping[str, tuple[str, ...]]
    machines: Mapping[tuple[str, str], np.ndarray]

    @staticmethod
    def vote(names: list[str], machines: Mapping, x: np.ndarray) -> tuple[str, float]:
        """The name that wins most duels, the sum of margins breaking ties, and its mean share in its own duels."""
        if len(names) == 1:
            return names[0], 1.0
        wins, margin, share = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            m = float(x @ machines[a, b][:-1] + machines[a, b][-1])
            p = 1 / (1 + np.exp(-np.clip(2 * m, -30, 30)))
            wins[a if m >= 0 else b] += 1
            margin[a], margin[b] = margin[a] + m, margin[b] - m
            share[a], share[b] = share[a] + p, share[b] + 1 - p
        best = max(names, key=lambda n: (wins[n], margin[n]))
        return best, share[best] / (len(names) - 1)

    def predict(self, text: bytes) -> tuple[str, float]:
        x = features(text)
        family, p = self.vote(sorted(self.families), self.machines, x)
        language, q = self.vote(sorted(self.families[family]), self.machines, x)
        return language, p * q


def family_of(language: str) -> str:
    return next((f"family:{name}" for name, members in FAMILIES.items() if language in members), f"family:{language}")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 400, max_languages: int = 200, most_rows: int = 8000) -> Model | None:
    """Fit on a bounded sample: of each language the ``per_language`` rows least in a hash of id and text.

    With many languages fewer of each, but one at least, so that there are at most ``most_rows`` in all or one for each
    language: this bounds what the driver holds. Only rows with a language and a letter count. Nothing but text and
    language is learned from. More than ``max_languages`` languages are an error. No usable row gives None. The sample
    does not depend on how the rows are partitioned; a repeated row counts against the number but is learned once.
    """
    usable = labelled.filter(F.col(lang).isNotNull() & has_letter(F.col(text))).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("h")
    )
    # Hashes are ranked first, so that only the sample's texts are moved. Equal hashes are equal rows.
    ranked = top_rows(usable.select("lang", "h"), ["lang"], [F.col("h")], per_language).groupBy("lang").agg(F.sort_array(F.collect_list("h")).alias("least"))
    found = ranked.limit(max_languages + 1).collect()  # at most per_language hashes of each
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not found:
        return None
    each = max(1, min(per_language, most_rows // len(found)))
    lasts = {r["lang"]: r["least"][:each][-1] for r in found}
    chosen = F.lit(False)
    for name, last in sorted(lasts.items()):
        chosen = chosen | ((F.col("lang") == name) & (F.col("h") <= last))
    sample = usable.filter(chosen).drop_duplicates(["lang", "h"]).select("lang", "h", F.col("text").cast("binary").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [zlib.compress(features(t.as_py()).astype(np.float32).tobytes(), 1) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(vectors, pa.binary())], names=["lang", "h", "x"])

    # Texts of any length stay in the tasks: the driver gets a vector of fixed size for each row of the sample,
    # packed, as most of its buckets are empty.
    rows = sample.mapInArrow(extract, "lang string, h long, x binary").orderBy("lang", "h").toArrow()
    x = np.empty((rows.num_rows, BUCKETS), np.float32)
    for i, v in enumerate(rows["x"]):
        x[i] = np.frombuffer(zlib.decompress(v.as_py()), np.float32)
    names = np.array(rows["lang"].to_pylist(), object)
    families: dict[str, list[str]] = {}
    for name in sorted(lasts):
        families.setdefault(family_of(name), []).append(name)
    groups = np.array([family_of(n) for n in names])
    machines = {}
    for labels, sets in ((groups, [sorted(families)]), (names, [sorted(v) for v in families.values()])):
        for members in sets:
            for a, b in combinations(members, 2):
                mine = (labels == a) | (labels == b)
                machines[a, b] = train_svm(x[mine], np.where(labels[mine] == a, 1.0, -1.0))
    return Model({k: tuple(v) for k, v in families.items()}, machines)


def identify(docs: DataFrame, model: Model | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with two more columns: the predicted language and its score between 0 and 1.

    The family is the winner of one-against-one machines between families, the language that of the machines inside the
    family; the score is the product of both winners' mean shares. Whole texts are read. Null texts, texts without a
    letter, and everything under a missing model are ``und`` with score 0. No row is dropped and none moves: there is no
    shuffle. Columns of the result's names are replaced.
    """
    keep = [c for c in docs.columns if c not in (lang_pred, score)]
    readable = F.when(has_letter(F.col(text)), F.col(text))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), readable.cast("binary").alias("readable"))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = [(UNDETERMINED, 0.0) if t is None or model is None else model.predict(t) for t in column.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([float(f[1]) for f in found], pa.float64())], ["l", "s"]
            )

    predict = F.arrow_udf(run, "l string, s double")
    out = rows.select("row", predict("readable").alias("p"))
    return out.select(*[F.col("row")[c].alias(c) for c in keep], F.col("p.l").alias(lang_pred), F.col("p.s").alias(score))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document belongs to the fold that training leaves out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0
