"""Language identification by Bayesian evidence fusion.

Evidence of a row, fused as log likelihoods plus a log prior:

* **text**: hashed character trigrams under a model of each language and an even background model (``und``).  Neighbouring trigrams
  are not independent, so the mean log likelihood counts as ``EFFECTIVE`` observations at most;
* **declared**: the declared markup language (``<html lang>`` or a table's language column), right with probability ``DECLARED``;
* **suffix**: a country suffix of the address that a parameter table maps to a language, right with probability ``SUFFIX``;
* **host prior**: language shares of the host, smoothed towards its domain's, those towards its suffix's, those towards the whole
  corpus's (``SMOOTHING`` pseudo rows at each level).

The languages are the labels of the data: every declared one with a text that holds a letter, at most ``MAX_LANGUAGES`` (those with the most different
texts, then by name).  The text model is fitted on at most ``SAMPLE`` different texts of each (whole texts, smallest hash of text and
label first): however rare a labelled language is and however often a text is copied, it has its model.  Everything else covers all
rows: one pass sums the text-only posteriors by host (combined map-side, so a host with a third of all rows is one partial
row a task), and a second pass judges every row with its host's prior.  The prior table grows with the number of hosts and is joined, not
collected.

A row is *accepted* if its best language is not ``und`` and its posterior is ``accept`` or more.

Defined results: null or empty texts, and texts without a letter, have no text evidence and are ``und`` (not accepted); null or unknown
declared languages, addresses and hosts are no evidence (a null host is a host of its own); repeated rows are judged alike; without a labelled
row all texts are ``und``; an empty table gives an empty result; all columns are kept, and input columns named like a result are replaced.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column, list_column

UND = "und"
MAX_LANGUAGES = 200
SAMPLE = 3000
BUCKETS = 1 << 15
EFFECTIVE = 48
DECLARED = 0.9
SUFFIX = 0.8
SMOOTHING = 20.0
ACCEPT = 0.5
#: country suffixes and the language that they speak for
COUNTRIES = {"de": "de", "at": "de", "ch": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "es": "es", "mx": "es", "ar": "es",
             "cl": "es", "co": "es", "fr": "fr", "be": "fr", "pt": "pt", "br": "pt", "it": "it", "nl": "nl", "pl": "pl", "se": "sv"}
RESULTS = ("language", "posterior", "accepted", "text_language")


@dataclass(frozen=True)
class Evidence:
    """Names of the columns that hold evidence; None where a table has none."""
    text: str = "text"
    declared: str | None = "lang"
    host: str | None = "source"


@dataclass(frozen=True)
class Model:
    """Languages by name, and (BUCKETS, languages and und) log likelihoods."""
    languages: tuple[str, ...]
    logs: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(text: str) -> np.ndarray:
    """Bucket of every character trigram that holds a letter; other characters count as one blank each."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(c):
        return np.empty(0, np.int64)
    letter = _letters()[c]
    if not letter.any():
        return np.empty(0, np.int64)
    c = np.concatenate([[0], np.where(letter, c, 0), [0]]).astype(np.uint64)
    letter = c != 0
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)
    h = ((h ^ (h >> np.uint64(15))) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - 15)
    return h[letter[1:-1]].astype(np.int64)


def fit(df: DataFrame, label: Column, text: str, sample: int = SAMPLE, most: int = MAX_LANGUAGES) -> Model:
    """The model of at most ``most`` labels from at most ``sample`` different texts of each."""
    labelled = (df.select(label.alias("label"), F.col(text).alias("text"))
                .filter((F.col("label") != "") & (F.col("label") != UND) & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("label", "text")))
    hashes = Scratch(df.sparkSession, "language-fit").write(labelled.select("label", "h").distinct(), "hashes")
    # at most ``most`` rows
    found = hashes.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most).collect()
    languages = tuple(sorted(r.label for r in found))
    if not languages:
        return Model((), np.zeros((BUCKETS, 1), np.float32))
    # hashes lie evenly, so a label's ``sample`` smallest are found below twice their share: few rows are ranked however many there are
    cuts = df.sparkSession.createDataFrame(
        [(r.label, min(2 ** 63 - 1, -2 ** 63 + (2 * sample + 100) * 2 ** 64 // r.n)) for r in found], "label string, cut long")
    smallest = (hashes.join(F.broadcast(cuts), "label").filter(F.col("h") <= F.col("cut"))
                .withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h"))).filter(F.col("r") <= sample).select("label", "h"))
    rows = (labelled.join(F.broadcast(smallest), ["label", "h"])
            .groupBy("label", "h").agg(F.min("text").alias("text")).select("label", "text"))
    at = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(at), BUCKETS), np.int64)
        for batch in batches:
            for lab, t in zip(batch.column("label").to_pylist(), batch.column("text")):
                total[at[lab]] += np.bincount(trigrams(t.as_py()), minlength=BUCKETS)
        which, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"language": pa.array(which, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
                                          "n": pa.array(total[which, bucket])})

    got = (rows.mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
           .toArrow())
    counts = np.zeros((BUCKETS, len(languages)), np.float64)
    counts[column(got, "bucket"), column(got, "language")] = column(got, "n")
    logs = np.full((BUCKETS, len(languages) + 1), -np.log(BUCKETS))
    # half an observation in every bucket
    logs[:, :-1] = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    return Model(languages, logs.astype(np.float32))


def text_evidence(texts, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods (rows x languages and und) of texts, and whether a text holds any."""
    out = np.zeros((len(texts), logs.shape[1]))
    some = np.zeros(len(texts), dtype=bool)
    for i, t in enumerate(texts):
        g = trigrams(t.as_py() or "")
        if len(g):
            # memory is bounded by the model's size however long the text is
            mean = (logs[g].mean(axis=0, dtype=np.float64) if len(g) <= BUCKETS
                    else np.bincount(g, minlength=BUCKETS) @ logs.astype(np.float64) / len(g))
            out[i] = mean * min(len(g), EFFECTIVE)
            some[i] = True
    return out, some


def _posterior(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def host_levels(host: Column) -> dict[str, Column]:
    """Suffix and domain of a host name; a name without dots is its own domain with an empty suffix."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return {"_suffix": F.when(n > 1, F.element_at(parts, -1)).otherwise(""),
            "_domain": F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")}


def host_priors(df: DataFrame, text: str, host: Column, model: Model, scratch: Scratch) -> DataFrame:
    """(_host, _prior): smoothed language shares of every host."""
    k = len(model.languages)
    sent = df.sparkSession.sparkContext.broadcast(model.logs)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, some = text_evidence(batch.column("text"), sent.value)
            p = _posterior(logs)
            p[~some] = 0
            yield pa.RecordBatch.from_pydict({"_host": batch.column("_host"), **{f"p{i}": pa.array(p[:, i]) for i in range(k)}})

    ps = [f"p{i}" for i in range(k)]
    rows = df.select(host.alias("_host"), F.col(text).alias("text")).mapInArrow(
        shares, "_host string, " + ", ".join(f"{p} double" for p in ps))
    # shares are summed in whole millionths, so that totals do not depend on the order of rows
    summed = rows.groupBy("_host").agg(*[F.sum(F.round(F.col(p) * 1e6).cast("long")).alias(p) for p in ps])
    summed = scratch.write(summed, "hosts")
    hosts = summed.select("_host", *[(F.col(p) / 1e6).alias(p) for p in ps]).withColumns(host_levels(F.col("_host")))

    def smoothed(parent: Column) -> Column:
        total = sum((F.col(p) for p in ps[1:]), F.col(ps[0]))
        return F.array(*[(F.col(p) + SMOOTHING * parent[i]) / (total + SMOOTHING) for i, p in enumerate(ps)])

    sums = [F.sum(p).alias(p) for p in ps]
    n = [x or 0.0 for x in hosts.agg(*sums).first()]     # one row: the whole corpus
    top = F.array(*[F.lit((x + SMOOTHING / k) / (sum(n) + SMOOTHING)) for x in n])
    suffixes = hosts.groupBy("_suffix").agg(*sums).select("_suffix", smoothed(top).alias("_sp"))
    domains = hosts.groupBy("_suffix", "_domain").agg(*sums).join(suffixes, "_suffix").select(
        "_suffix", "_domain", smoothed(F.col("_sp")).alias("_dp"))
    return hosts.join(domains, ["_suffix", "_domain"]).select("_host", smoothed(F.col("_dp")).alias("_prior"))


def identify(df: DataFrame, evidence: Evidence = Evidence(), accept: float = ACCEPT, model: Model | None = None) -> DataFrame:
    """``df`` with language, posterior, accepted and text_language (by text alone)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "language-id")
    df = df.drop(*RESULTS)
    names, fields = df.columns, df.schema.fields
    declared = (F.lower(F.regexp_extract(F.coalesce(F.col(evidence.declared), F.lit("")), "^[A-Za-z]+", 0)) if evidence.declared
                else F.lit(""))
    host = F.coalesce(F.col(evidence.host).cast("string"), F.lit("")) if evidence.host else F.lit("")
    if model is None:
        model = fit(df, declared, evidence.text)
    k = len(model.languages)
    if not k:
        return df.withColumns({"language": F.lit(UND), "posterior": F.lit(0.0), "accepted": F.lit(False), "text_language": F.lit(UND)})
    priors = scratch.write(host_priors(df, evidence.text, host, model, scratch), "priors")
    sent = spark.sparkContext.broadcast(model.logs)
    rows = df.withColumns({"_declared": declared, "_host": host}).withColumn("_suffix", host_levels(F.col("_host"))["_suffix"])
    joined = rows.join(priors, "_host", "left").select(*names, "_declared", "_suffix",
                                                       F.coalesce("_prior", F.array(*[F.lit(1 / k)] * k)).alias("_prior"))
    result = T.StructType([*fields, T.StructField("language", T.StringType()), T.StructField("posterior", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType()), T.StructField("text_language", T.StringType())])
    labels = np.array([*model.languages, UND])
    index = {x: i for i, x in enumerate(model.languages)}
    declares = {x: x for x in index}
    speaks = {suffix: x for suffix, x in COUNTRIES.items() if x in index}

    def vote(values: list, table: dict[str, str], right: float) -> np.ndarray:
        out = np.zeros((len(values), k + 1))
        for i, v in enumerate(values):
            if v in table:
                out[i] = np.log((1 - right) / max(k - 1, 1))
                out[i, index[table[v]]] = np.log(right)
        return out

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            logs, some = text_evidence(batch.column(evidence.text), sent.value)
            by_text = np.where(some, labels[logs.argmax(axis=1)], UND)
            values, offsets = list_column(batch, "_prior")
            prior = values[offsets[0]:offsets[-1]].reshape(n, k)
            # the background model takes the share of one pseudo row
            prior = np.concatenate([prior * SMOOTHING, np.ones((n, 1))], axis=1) / (SMOOTHING + 1)
            logs = logs + np.log(prior) + vote(batch.column("_declared").to_pylist(), declares, DECLARED) \
                + vote(batch.column("_suffix").to_pylist(), speaks, SUFFIX)
            p = _posterior(logs)
            best = p.argmax(axis=1)
            language = np.where(some, labels[best], UND)
            top = np.round(np.where(some, p[np.arange(n), best], 0.0), 6)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(language.tolist(), pa.string()), pa.array(top),
                 pa.array((language != UND) & (top >= accept)), pa.array(by_text.tolist(), pa.string())],
                names=[f.name for f in result.fields])

    return joined.mapInArrow(judge, result)
