"""Language of web pages by Bayesian fusion of evidence.

Four kinds of evidence are multiplied: the likelihood of the page's text (byte trigrams, counted over all documents of
known language), the language that the markup declares (how often it is declared on pages whose text is of each language), and a
prior of the host, smoothed towards its domain, that towards its address suffix, and that towards all pages. Counts come from
grouped aggregation of the texts' own posteriors; a page doesn't count for its own host's prior.

The text model has a fixed size (CELLS hashed trigrams per language). A text's log-likelihood is tempered to EVIDENCE
trigrams, as neighbouring trigrams aren't independent. Tables by host, domain, suffix and declared language stay
tables; a host with a third of all pages is combined before its shuffle, and its join is split by adaptive execution.

Text within <nav> and <footer> is left out, unless the page has no other.

Nulls: a page without markup has no text and declares nothing, one without URL has an empty host; what is missing says
nothing. Documents without text or language teach nothing; without any such document the language is null. Repeated
pages are judged alike. Other columns are carried along; those with the names of the new columns are replaced."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspan.llm.sums import sum_vectors
from dwellspan.llm.text import free_name, mix, text_chunks
from dwellspan.llm.urlfilter import host_of
from dwellspan.session import materialise

CELLS, SMOOTH, EVIDENCE, STRENGTH, MAX_LANGUAGES = 1 << 14, 0.5, 60.0, 5.0, 1000
_OPENING = re.compile(r"<(script|style|nav|footer)\b", re.I)
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "nav", "footer")}
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([a-z]+)", re.I)


def _text_outside(page: str, dropped: tuple[str, ...]) -> str:
    """The page without comments, tags, and elements of these names, each replaced by a blank. What isn't closed is a tag, and
    without a `>` text. One walk from left to right: where no closing mark is found once, none is looked for again."""
    parts, at, never = [], 0, set()

    def find(mark: str, start: int) -> int:
        if mark in never:
            return -1
        if mark in _CLOSING:
            found = _CLOSING[mark].search(page, start)
            place = found.end() if found else -1
        else:
            place = page.find(mark, start)
            place = place + len(mark) if place >= 0 else -1
        if place < 0:
            never.add(mark)
        return place

    while (tag := page.find("<", at)) >= 0:
        end = find("-->", tag + 4) if page.startswith("<!--", tag) else -1
        if end < 0 and (opening := _OPENING.match(page, tag)) and opening[1].lower() in dropped:
            end = find(opening[1].lower(), opening.end())
        if end < 0 and (end := find(">", tag + 1)) < 0:
            break
        parts.append(page[at:tag])
        at = end
    return " ".join([*parts, page[at:]])


def visible_text(page: str) -> str:
    """Text outside of <nav> and <footer>, or theirs if there is no other."""
    text = html.unescape(_text_outside(page, tuple(_CLOSING)))
    return text if text.strip() else html.unescape(_text_outside(page, ("script", "style")))


def declared_language(page: str) -> str:
    at = 0
    while tag := _HTML.search(page, at):
        at = page.find(">", tag.end())
        end = at if at >= 0 else len(page)
        if found := _LANG.search(page, tag.end(), end):
            return found[1].lower()
        if at < 0:
            break
    return ""


def trigram_cells(data: np.ndarray, offsets: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row) of each byte trigram within a text, letters of any script lower-cased as far as ASCII goes."""
    b = data.astype(np.uint64)
    b[(b >= 65) & (b <= 90)] += np.uint64(32)
    n = max(0, len(b) - 2)
    value = (b[:n] << np.uint64(16)) | (b[1 : n + 1] << np.uint64(8)) | b[2 : n + 2]
    row = np.searchsorted(offsets, np.arange(n), "right") - 1
    inside = np.arange(n) + 2 < offsets[row + 1]
    return (mix(value[inside]) % np.uint64(cells)).astype(np.int64), row[inside]


class TextModel:
    """Log-probabilities of trigram cells by language."""

    def __init__(self, languages: list[str], counts: np.ndarray, smooth: float = SMOOTH):
        self.languages = languages
        whole = counts + smooth
        self.logs = np.log(whole / whole.sum(axis=1, keepdims=True))

    def log_likelihoods(self, data: np.ndarray, offsets: np.ndarray, evidence: float = EVIDENCE) -> np.ndarray:
        cells, row = trigram_cells(data, offsets, self.logs.shape[1])
        rows = len(offsets) - 1
        n = np.bincount(row, minlength=rows)
        sums = np.stack([np.bincount(row, logs[cells], rows) for logs in self.logs], axis=1)
        return sums * (np.minimum(n, evidence) / np.maximum(n, 1))[:, None]


def fit_text_model(docs: DataFrame, language: str = "lang", text: str = "text", cells: int = CELLS) -> TextModel:
    """Trigram counts of all documents. Languages are those of the column; their number bounds the model, so more than
    MAX_LANGUAGES are an error."""
    named = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    languages = sorted(r[0] for r in named.select(language).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {language}")
    place = {name: i for i, name in enumerate(languages)}

    def part(batch):
        at = np.array([place[v] for v in batch.column(0).to_pylist()], dtype=np.int64)
        total: dict[int, np.ndarray] = {}
        for first, end, data, offsets in text_chunks(batch.column(1)):
            cell, row = trigram_cells(data, offsets, cells)
            who = at[first:end][row]
            for i in np.unique(who).tolist():
                total[i] = total.get(i, 0) + np.bincount(cell[who == i], minlength=cells)
        return total

    sums = sum_vectors(named.select(F.col(language).cast("string"), F.col(text).cast("string")), part)
    counts = np.zeros((len(languages), cells))
    for i, vector in sums.items():
        counts[i] = vector
    return TextModel(languages, counts)


def _text_evidence(pages: DataFrame, model: TextModel, url: str, markup: str) -> DataFrame:
    """`pages` with host, domain, suffix, the declared language, log-likelihoods and posteriors of the text alone."""
    shipped = pages.sparkSession.sparkContext.broadcast(model)
    page = free_name(pages, "page")
    host = host_of(F.col(url))
    labels = F.split(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":\d*$", ""), r"\.", -1)
    rows = pages.withColumns({
        "__host": F.array_join(labels, "."), "__domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "__suffix": F.element_at(labels, -1), page: F.col(markup).cast("string"),
    })
    names = [*rows.columns[:-1], "__declared", "__logs", "__share"]

    def run(batches):
        known = shipped.value
        width = len(known.languages)
        lists = lambda x: pa.ListArray.from_arrays(
            pa.array(np.arange(0, x.size + 1, width, dtype=np.int32)), pa.array(x.ravel())
        )
        for batch in batches:
            pages_ = [v or "" for v in batch.column(batch.num_columns - 1).to_pylist()]
            declared = pa.array([declared_language(p) for p in pages_], pa.string())
            texts = pa.array([visible_text(p) for p in pages_], pa.string())
            for first, end, data, offsets in text_chunks(texts):
                logs = known.log_likelihoods(data, offsets)
                share = np.exp(logs - logs.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                part = batch.slice(first, end - first).columns[:-1]
                yield pa.RecordBatch.from_arrays([*part, declared.slice(first, end - first), lists(logs), lists(share)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, __declared string, __logs array<double>, __share array<double>")


def _sums(rows: DataFrame, keys: list[str], share: str, width: int, name: str) -> DataFrame:
    """Per key, the sum of an array column, by position."""
    sums = rows.groupBy(*keys).agg(*[F.sum(F.get(F.col(share), F.lit(i))).alias(f"__{i}") for i in range(width)])
    return sums.select(*keys, F.array(*[F.col(f"__{i}") for i in range(width)]).alias(name))


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda n, p: (n + strength * p) / (total + strength))


def identify(
    pages: DataFrame, model: TextModel, url: str = "url", markup: str = "html", strength: float = STRENGTH
) -> DataFrame:
    """`pages` with host, declared (language of the markup), lang and confidence (its posterior)."""
    # within, other columns have names that none of ours is
    new = ("host", "declared", "lang", "confidence")
    names = [c for c in pages.columns if c.lower() not in new]
    plain = pages.toDF(*[f"c{i}" for i in range(len(pages.columns))])
    place = {c: f"c{i}" for i, c in enumerate(pages.columns)}
    judged = _judged(plain.select(*[place[c] for c in names]), model, place[url], place[markup], strength)
    return judged.toDF(*names, *new)


def _judged(pages: DataFrame, model: TextModel, url: str, markup: str, strength: float) -> DataFrame:
    width = len(model.languages)
    if not width:
        nothing = {"declared": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")}
        return pages.withColumns({"host": host_of(F.col(url))} | nothing)
    rows = materialise(_text_evidence(pages, model, url, markup), "evidence")
    by_host = materialise(_sums(rows, ["__host", "__domain", "__suffix"], "__share", width, "n"), "hosts")
    by_domain = _sums(by_host, ["__domain", "__suffix"], "n", width, "nd")
    by_suffix = _sums(by_domain, ["__suffix"], "nd", width, "ns")
    whole = _sums(by_suffix, [], "ns", width, "all")
    even = F.array(*[F.lit(1.0 / width)] * width)
    prior = [r[0] for r in whole.where("all[0] is not null").select(_smoothed(F.col("all"), even, strength)).collect()]
    top = F.array(*[F.lit(float(v)) for v in (prior[0] if prior else [1.0 / width] * width)])
    hosts = (
        by_host.join(by_domain, ["__domain", "__suffix"]).join(by_suffix, "__suffix")
        .withColumn("parent", _smoothed(F.col("ns"), top, strength))
        .withColumn("parent", _smoothed(F.col("nd"), F.col("parent"), strength))
        .select("__host", "n", "parent")
    )
    # P(declared | language), smoothed over the values that are declared at all
    said = materialise(_sums(rows.where("__declared <> ''"), ["__declared"], "__share", width, "said"), "declared")
    values = said.count()
    totals = [float(v or 0) for v in said.agg(*[F.sum(F.get("said", F.lit(i))) for i in range(width)]).first()]
    whole_said = F.array(*[F.lit(t) for t in totals])
    rate = F.zip_with("said", whole_said, lambda n, t: F.log((n + 1.0) / (t + float(values))))
    known = said.select("__declared", rate.alias("said"))
    nothing = F.array(*[F.lit(0.0)] * width)
    joined = rows.join(materialise(hosts, "priors"), "__host").join(materialise(known, "said"), "__declared", "left")
    others = F.zip_with("n", "__share", lambda n, own: F.greatest(n - own, F.lit(0.0)))  # without the page itself
    logs = F.zip_with(
        F.zip_with("__logs", _smoothed(others, F.col("parent"), strength), lambda a, p: a + F.log(p)),
        F.coalesce("said", nothing), lambda a, b: a + b,
    )
    scored = joined.withColumn("__logs", logs)
    best = F.array_max("__logs")
    mass = F.aggregate(F.transform("__logs", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(v) for v in model.languages])
    return scored.select(
        *pages.columns, F.col("__host").alias("host"), F.nullif("__declared", F.lit("")).alias("declared"),
        F.get(names, F.array_position("__logs", best).cast("int") - 1).alias("lang"), (F.lit(1.0) / mass).alias("confidence"),
    )
