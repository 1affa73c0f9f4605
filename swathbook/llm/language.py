"""Language identification in two steps: the family by a multinomial model, the language inside it by pairwise SVMs.

Features are the character n-grams (1 to 4 characters of lower-cased words, a word's start and end included), hashed
to SIZE slots. The family step is a naive Bayes model over slot counts; inside a family, one linear support vector
machine for each pair of its languages (square-root counts, length 1; squared hinge loss) votes, and the sum of margins
breaks ties. A family of one language needs no second step.

The models are fitted on a bounded sample: about PER_LANGUAGE distinct texts of each language, chosen by a hash of the
text. Everything else, the predictions, covers whole texts of all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package

#: Hash slots of n-grams, and the longest n-gram.
SIZE, LONGEST = 1 << 13, 4
#: Texts of each language in the fitting sample (about; chosen by hash).
PER_LANGUAGE = 400
#: Characters of a text taken at once.
CHUNK = 1 << 18
# Families of ISO 639-1 codes; a code that is not listed is a family of its own
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd", "gv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "or", "pa", "sa", "sd", "si", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["am", "ar", "he", "mt", "ti"],
    "austronesian": ["haw", "id", "jv", "mg", "mi", "ms", "su", "tl"],
}


def family_of(language: str) -> str:
    base = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, members in FAMILIES.items() if base in members), f"only {language}")


def slot_counts(text: str) -> np.ndarray | None:
    """Counts of n-gram slots of a whole text; None if it has no letter."""
    total, letters = np.zeros(SIZE), False
    begin = 0
    while begin < len(text):
        end = min(len(text), begin + CHUNK)
        if end < len(text):  # cut between words where there are any
            space = max(text.rfind(" ", begin, end), text.rfind("\n", begin, end))
            end = space + 1 if space > begin else end
        part = text[begin:end].lower()
        begin = end
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(part, codes)
        if not letter.any():
            continue
        letters = True
        # runs of other characters become one mark, so that words keep a start and an end
        code = np.where(letter, codes, 0).astype(np.uint64)
        code = np.concatenate([[0], code[letter | np.concatenate([[True], letter[:-1]])], [0]]).astype(np.uint64)
        grown = np.zeros(len(code), np.uint64)
        for size in range(1, LONGEST + 1):
            grown = grown[: len(code) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + code[size - 1 :] + np.uint64(size)
            if not len(grown):
                break
            mixed = grown ^ (grown >> np.uint64(29))
            total += np.bincount(((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(51)).astype(np.int64), minlength=SIZE)
    return total if letters else None


def _letters(text: str, codes: np.ndarray) -> np.ndarray:
    """Which characters are letters (of any script)."""
    lut = np.zeros(128, bool)
    lut[97:123] = True
    out = lut[np.minimum(codes, 127)] & (codes < 128)
    for value in np.unique(codes[codes >= 128]):
        if not 0xD800 <= value <= 0xDFFF and chr(value).isalpha():
            out |= codes == value
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    families: list[str]
    family_of: np.ndarray
    log_prob: np.ndarray  # families x SIZE
    log_prior: np.ndarray
    pairs: list[tuple[int, int]]  # languages of one family
    planes: np.ndarray  # pairs x (SIZE + 1), the last is the bias

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        """Language and score of one text's slot counts. The score is the product of the family's probability (per
        n-gram log-likelihoods, so that long texts are not always certain) and the mean pairwise probability."""
        share = counts / counts.sum()
        likely = SCALE * (self.log_prob @ share) + self.log_prior
        likely = np.exp(likely - likely.max())
        likely /= likely.sum()
        family = int(likely.argmax())
        members = np.flatnonzero(self.family_of == family)
        if len(members) == 1:
            return self.languages[members[0]], float(likely[family])
        x = np.sqrt(counts)
        x /= np.linalg.norm(x)
        votes = {int(m): [0, 0.0, 0.0] for m in members}
        for (one, two), plane in zip(self.pairs, self.planes, strict=True):
            if self.family_of[one] == family:
                margin = float(x @ plane[:-1] + plane[-1])
                sure = 1 / (1 + np.exp(-2 * margin))
                votes[one if margin >= 0 else two][0] += 1
                for language, sign, p in ((one, 1, sure), (two, -1, 1 - sure)):
                    votes[language][1] += sign * margin
                    votes[language][2] += p
        best = max(votes, key=lambda m: (votes[m][0], votes[m][1], -m))
        return self.languages[best], float(likely[family] * votes[best][2] / (len(members) - 1))


#: Weight of the mean log-likelihood of an n-gram in the family's probability.
SCALE = 40.0


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by accelerated gradient descent; y is 1 or -1.

    ``x`` is single precision with rows of length 1; no copy of it is made.
    """
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = z = np.zeros(x.shape[1] + 1, np.float32)
    rate, t = np.float32(1 / (4 + penalty)), 1.0  # rows have length sqrt(2) with the bias and weights sum to 1
    for _ in range(steps):
        pull = weight * y * np.maximum(0, 1 - y * (x @ z[:-1] + z[-1]))
        step = z - rate * (np.float32(penalty) * z - 2 * np.append(pull @ x, pull.sum()))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = step + np.float32((t - 1) / t_next) * (step - w)
        w, t = step, t_next
    return w.astype(np.float64)


def fit_model(labels: list[str], counts: np.ndarray) -> LanguageModel:
    """Fit on rows of slot counts, which are overwritten."""
    languages = sorted(set(labels))
    number = {v: i for i, v in enumerate(languages)}
    y = np.array([number[v] for v in labels])
    families = sorted({family_of(v) for v in languages})
    owner = np.array([families.index(family_of(v)) for v in languages])
    sums = np.zeros((len(families), SIZE))
    for f in range(len(families)):
        for m in np.flatnonzero(owner == f):  # languages weigh alike
            rows = np.flatnonzero(y == m)
            share = 1 / counts[rows].sum(1)
            sums[f] += share @ counts[rows] / len(rows) / (owner == f).sum()
    log_prob = np.log((sums + 0.1 / SIZE) / 1.1)
    x = np.sqrt(counts, out=counts)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs, planes = [], []
    for one in range(len(languages)):
        for two in range(one + 1, len(languages)):
            if owner[one] == owner[two]:
                rows = np.flatnonzero((y == one) | (y == two))
                pairs.append((one, two))
                planes.append(linear_svm(x[rows], np.where(y[rows] == one, 1.0, -1.0)))
    prior = np.full(len(families), -np.log(max(1, len(families))))
    return LanguageModel(languages, families, owner, log_prob, prior, pairs, np.array(planes).reshape(len(pairs), SIZE + 1))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, slots, values = [], [], []
        for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts = slot_counts(text)
            if counts is not None:
                used = np.flatnonzero(counts)
                lang.append(language), slots.append(used.astype(np.int32)), values.append(counts[used].astype(np.float32))
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(lang, pa.string()), "slots": pa.array(slots, pa.list_(pa.int32())), "counts": pa.array(values, pa.list_(pa.float32()))}
        )


def fit_languages(df: DataFrame, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on about ``per_language`` distinct texts of each value of ``lang``; None if no row has both text and lang.

    Rows with a null lang or text, or a text without a letter, teach nothing; equal texts of a language count once.
    """
    ship_package(df.sparkSession)
    known = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    keyed = known.withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not sizes:
        return None
    limit = F.lit(None).cast("double")
    for value, n in sizes.items():
        limit = F.when(F.col("lang") == value, F.lit(min(1.0, per_language / n))).otherwise(limit)
    chosen = keyed.where(F.pmod("h", F.lit(1 << 20)) < limit * F.lit(1 << 20)).dropDuplicates(["lang", "h"]).select("lang", "text")
    rows = chosen.mapInArrow(_features, "lang string, slots array<int>, counts array<float>")
    got = rows.repartition(1).mapInArrow(_fitted, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows, which are the bounded sample; one task on an executor fits it."""
    rows = [
        (lang, np.asarray(slots), np.asarray(counts, np.float32))
        for batch in batches
        for lang, slots, counts in zip(batch.column("lang").to_pylist(), batch.column("slots").to_pylist(), batch.column("counts").to_pylist(), strict=True)
    ]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    if rows:
        counts = np.zeros((len(rows), SIZE), np.float32)
        for i, (_, slots, values) in enumerate(rows):
            counts[i, slots] = values
        model = fit_model([r[0] for r in rows], counts)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})


def identify_languages(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred (string) and lang_score (double, 0 to 1), replaced if they exist.

    Null and empty texts, texts without a letter, and all texts where no model could be fitted, get ``und`` and 0.
    Whole texts are read; long ones in pieces. Repeated rows get equal results; an empty table stays empty.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        held = shared.value
        out = []
        for value in texts:
            counts = slot_counts(value.as_py() or "") if held is not None else None
            out.append(("und", 0.0) if counts is None else held.predict(counts))
        names, scores = zip(*out, strict=True) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    kept = [c for c in df.columns if c not in ("lang_pred", "lang_score")]
    found = df.select(*kept, F.arrow_udf(predict, "struct<lang:string,score:double>")(text).alias("lang_pred"))
    return found.select(*kept, F.col("lang_pred.lang").alias("lang_pred"), F.col("lang_pred.score").alias("lang_score"))
