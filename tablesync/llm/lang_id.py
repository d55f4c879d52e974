"""Language ID by hierarchical discrimination.

First a linear multi-class support vector machine names the language family; then, within the
family, one-versus-one linear support vector machines vote between the closely related languages.
Features are hashed byte n-grams of the lower-cased letters (words with their spaces), square-root
scaled and of unit length, taken from the whole text.

Defined results: a text that is null, empty or has no letter is ``und`` with score 0. A
table with no usable labelled row gives ``und`` for every row. Ties between languages go to the
smaller code. Repeated rows and null ids are rows like any other; extra columns travel along, but ``lang_pred`` and ``score`` are
replaced. Very long texts are read whole, in rows of n-gram counts of fixed size; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

UNDETERMINED = "und"
DIMS = 1 << 13
GRAMS = (2, 3, 4)
HASHES = 1 << 62  # of texts; a share of a language of any size is above 0

# Families of common languages (ISO 639-1). A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "semitic": ["ar", "he", "mt"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), lang)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows of unit n-gram vectors, some rows at a time."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    for _, _, buf, offsets in slices(lowered):
        n = len(offsets) - 1
        size = np.diff(offsets)
        letters = np.where(_LETTER[buf], buf, 32).astype(np.uint64)
        row = np.repeat(np.arange(n), size)
        blank = letters == 32
        keep = np.ones(len(buf), bool)  # one blank for a run of them
        keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
        letters, row = letters[keep], row[keep]
        for lo in range(0, n, 256):  # bounds the dense rows
            hi = min(n, lo + 256)
            a, b = np.searchsorted(row, [lo, hi])
            part, at = letters[a:b], row[a:b] - lo
            out = np.zeros((hi - lo) * DIMS, np.float32)
            for g in GRAMS:
                if len(part) < g:
                    continue
                code = np.zeros(len(part) - g + 1, np.uint64)
                for k in range(g):
                    code = code * np.uint64(257) + part[k : len(part) - g + 1 + k]
                same = at[: len(code)] == at[g - 1 :]
                slot = ((code * np.uint64(0x9E3779B97F4A7C15 + 2 * g)) >> np.uint64(51)).astype(np.int64)
                out += np.bincount((at[: len(code)] * DIMS + slot)[same], minlength=len(out)).astype(np.float32)
            out = np.sqrt(out.reshape(hi - lo, DIMS))
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            yield out / np.where(norm > 0, norm, 1)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30, seed: int = 7, pick: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the bias) of a two-class linear SVM with squared hinge loss; y is -1 or 1.

    Dual coordinate descent with classes weighted by their inverse share, seeded, so reruns agree. ``x`` may be of half
    precision and is never copied: rows (those of ``pick``, if given) are widened one at a time.
    """
    n = len(y)
    pick = np.arange(n) if pick is None else pick
    weight = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum())))
    diag = 1 / (2 * c * weight)
    q = np.empty(n)
    for i in range(n):
        row = x[pick[i]].astype(np.float64)
        q[i] = row @ row + 1 + diag[i]
    alpha, w, bias = np.zeros(n), np.zeros(x.shape[1]), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            row = x[pick[i]].astype(np.float64)
            gradient = y[i] * (w @ row + bias) - 1 + diag[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / q[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                row *= step
                w += row
                bias += step
                moved = max(moved, abs(new - alpha[i]) * q[i])
                alpha[i] = new
        if moved < 1e-2:
            break
    return np.append(w, bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(4 * x, -50, 50)))


@dataclass
class LanguageModel:
    """Families, one SVM against the rest per family, and one SVM per pair of languages of a family."""

    families: list[str]
    members: dict[str, list[str]]
    family_w: np.ndarray  # one row per family
    pair_w: dict[tuple[str, str], np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, lang: np.ndarray, order: np.ndarray | None = None) -> LanguageModel:
        """``order``: the order in which the rows are taken, so that reruns agree."""
        order = np.arange(len(lang)) if order is None else order
        lang = lang[order]
        kin = np.array([family_of(str(v)) for v in lang])
        families = sorted(set(kin))
        members = {f: sorted({str(v) for v in lang[kin == f]}) for f in families}
        rest = [linear_svm(x, np.where(kin == f, 1.0, -1.0), pick=order) for f in families] if len(families) > 1 else []
        family_w = np.array(rest) if rest else np.zeros((len(families), x.shape[1] + 1))
        pairs = {}
        for names in members.values():
            for a, b in combinations(names, 2):
                pick = np.flatnonzero((lang == a) | (lang == b))
                pairs[a, b] = linear_svm(x, np.where(lang[pick] == a, 1.0, -1.0), pick=order[pick])
        return cls(families, members, family_w.astype(np.float32), {k: v.astype(np.float32) for k, v in pairs.items()})

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language codes and scores from 0 to 1 (family confidence times the mean pair confidence)."""
        margins = x @ self.family_w[:, :-1].T + self.family_w[:, -1]
        best = margins.argmax(1)
        sure = _sigmoid(margins)
        score = sure[np.arange(len(x)), best] if len(self.families) > 1 else np.ones(len(x))
        out = np.empty(len(x), object)
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            langs = self.members[name]
            if not len(rows):
                continue
            votes, trust = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            for (a, b), w in self.pair_w.items():
                if a in langs:
                    p = _sigmoid(x[rows] @ w[:-1] + w[-1])
                    i, j = langs.index(a), langs.index(b)
                    votes[:, i] += p >= 0.5
                    votes[:, j] += p < 0.5
                    trust[:, i] += p
                    trust[:, j] += 1 - p
            pick = (votes + trust / (len(langs) + 1)).argmax(1)
            out[rows] = np.array(langs, object)[pick]
            if len(langs) > 1:
                score[rows] *= trust[np.arange(len(rows)), pick] / (len(langs) - 1)
        return out, np.clip(score, 0, 1)


def fit_language_model(labelled: DataFrame, per_language: int = 400, max_rows: int = 6400, max_languages: int = 200) -> LanguageModel | None:
    """Fit on a bounded sample: about ``per_language`` distinct texts of each language, by a hash of the text; all if it has fewer.

    Counts per language are of the distinct texts of all labelled rows, so neither copies nor size thin a language out; the sampled rows become n-gram vectors on the
    executors, so what reaches the driver is bounded whatever the length of the texts: by ``max_rows`` vectors of
    16 KB, which the languages share where there are many. Of more than ``max_languages`` labels, those with the most texts are learned.
    """
    spark = labelled.sparkSession
    good = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", F.col("lang").cast("string").alias("lang"))
    counts = good.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not counts:
        return None
    each = min(per_language, max_rows // len(counts))
    shares = [(r["lang"], int(min(1.0, each / max(1, r["n"])) * HASHES)) for r in counts]
    sample = good.join(F.broadcast(spark.createDataFrame(shares, "lang string, share long")), "lang").where(F.pmod(F.xxhash64("text"), F.lit(HASHES)) < F.col("share"))

    def vectors(batches):
        for batch in batches:
            at, langs = 0, batch.column("lang")
            for rows in features(batch.column("text")):
                data = [row.tobytes() for row in rows.astype(np.float16)]
                yield pa.RecordBatch.from_arrays([langs.slice(at, len(rows)), batch.column("h").slice(at, len(rows)), pa.array(data, pa.binary())], ["lang", "h", "x"])
                at += len(rows)

    # copies of one text share its hash, so a text is taken once
    rows = sample.dropDuplicates(["lang", "text"]).select("lang", F.xxhash64("text").alias("h"), "text").mapInArrow(vectors, "lang string, h long, x binary").toArrow()
    if not rows.num_rows:
        return None
    x, at = np.empty((rows.num_rows, DIMS), np.float16), 0
    for part in rows["x"].chunks:
        for value in part:
            x[at] = np.frombuffer(value.as_buffer(), np.float16)
            at += 1
    lang, h = np.array(rows["lang"].to_pylist(), object), np.asarray(rows["h"])
    del rows
    order = np.lexsort((h, lang.astype(str)))
    return LanguageModel.fit(x, lang, order)


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (its ``text``) plus ``lang_pred`` and ``score``; one pass, no shuffle."""
    extra = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in extra])
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in extra] + ["lang_pred string", "score double"])

    def predict(batches):
        fitted = broadcast.value
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            letters = np.asarray(pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False), bool)
            lang, score = np.full(len(text), UNDETERMINED, object), np.zeros(len(text))
            at = 0
            for rows in features(text) if fitted is not None else ():
                lang[at : at + len(rows)], score[at : at + len(rows)] = fitted.predict(rows)
                at += len(rows)
            lang[~letters], score[~letters] = UNDETERMINED, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(predict, schema)
