"""Personal data: fixed patterns, and information-theoretic sanitisation of what gives it away.

The patterns find e-mail addresses, IP addresses, card and phone numbers; each distinct value is a
protected entity. A term is a word of a document with an entity, wherever it stands in it. Over the
whole corpus,

    disclosure(t, e) = PMI(t, e) / IC(e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e)),

with numbers of documents: 1 means that whoever reads the term knows the entity, 0 that it tells
nothing. The ``WINDOW`` words on each side of an entity name the passage it stands in. Copies of one
passage are one piece of evidence, so a pair also needs ``SUPPORT`` different passages: each document
with both gives one, and each other passage of it that the term is part of another. A term of at least
``GENERALISE`` is replaced by its kind of word, one of at least ``REMOVE`` is taken out, wherever it
stands in the documents with the entity. A document without an entity is left alone.

Only entities in ``SUPPORT`` passages can have such a pair, so only their documents are taken apart.
Document frequencies are counted over all documents, but only of terms that some pair still needs: a
bit map of fixed size says which words may be among them, and a join then decides.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import free_names, text_sha
from scholarmill.session import stored

BASE = ("email", "ip", "card", "phone")
ADDED = ("removed", "generalised")
KINDS = (*BASE, *ADDED)
WINDOW = 8
SUPPORT = 3
GENERALISE, REMOVE = 0.7, 0.9
BITS = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match never begins inside a run of digits: the run's first digit would have matched before.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """From each @ to the left and to the right, in time proportional to the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at) if start < at else None
        if host:
            yield "email", start, host.end()
            end = host.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) in code points, by start, then kind. Matches that fail are dropped."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else re.sub('[^0-9.]' if kind == 'ip' else '[^0-9]', '', value)}"


def nearby(text: str, spans: list[Span]) -> list[tuple[str, str | None, int]]:
    """(entity, term, window) of the words around each span that lie in no span; term None for a span alone.

    The window is a number drawn from its words, the same wherever the passage is copied to.
    """
    taken = sorted((a, b) for _, a, b in spans)
    out = set()
    for kind, start, end in spans:
        around = [(m.start() + a, m.end() + a) for a, part in _sides(text, start, end) for m in part]
        words = [text[a:b].lower() for a, b in around if not any(x < b and a < y for x, y in taken)]
        window = zlib.crc32(" ".join(words).encode())
        out.update((_entity(kind, text[start:end]), w, window) for w in words or [None])
    return sorted(out, key=lambda w: (w[0], w[1] or "", w[2]))


def _sides(text: str, start: int, end: int) -> Iterator[tuple[int, list]]:
    """The last words before and the first after a span, with the place their part of text begins."""
    reach = 64
    while True:
        low = max(0, start - reach)
        # A word that the part cuts does not count.
        part = [m for m in _WORD.finditer(text[low:start]) if low == 0 or m.start()]
        if len(part) >= WINDOW or low == 0 or reach > 1 << 16:
            yield low, part[-WINDOW:]
            break
        reach *= 2
    reach = 64
    while True:
        high = min(len(text), end + reach)
        part = [m for m in _WORD.finditer(text[end:high]) if high == len(text) or m.end() < high - end]
        if len(part) >= WINDOW or high == len(text) or reach > 1 << 16:
            yield end, part[:WINDOW]
            break
        reach *= 2


def _free(text: str) -> Iterator[re.Match]:
    """All words that lie in no base span, in time proportional to the text."""
    spans: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base_spans(text)):
        if spans and a < spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    i = 0
    for m in _WORD.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if i == len(spans) or m.end() <= spans[i][0]:
            yield m


_NEAR = "array<struct<entity:string,term:string,window:long>>"
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, sha, base (spans) and near (the words around them) of every row."""
    near_kind = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("window", pa.int64())]))
    span_kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            base, near = [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                near.append([dict(zip(("entity", "term", "window"), w)) for w in nearby(text, spans)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(base, span_kind), pa.array(near, near_kind)],
                names=["doc_id", "sha", "base", "near"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_sha().alias("sha"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, f"doc_id long, sha binary, base {_SPANS}, near {_NEAR}")


def _document_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term and n_term, the number of documents with each of ``terms``."""
    bit = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITS)).cast("int")
    words = terms.select(F.floor(bit / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(crc32(cast(term as binary)), {BITS}) % 64 as int))").alias("b"))
    # The bit map has a fixed size: at most BITS / 64 rows come to the driver.
    bits = np.zeros(BITS // 64, np.int64)
    for row in words.groupBy("at").agg(F.bit_or("b").alias("b")).collect():
        bits[row["at"]] = row["b"]
    flags = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)
    if not flags.any():
        return terms.limit(0).withColumn("n_term", F.lit(0).cast("long"))
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def run(batches):
        wanted = shared.value
        for batch in batches:
            counts, known = Counter(), {}
            for text in batch.column(0).to_pylist():
                for w in set(_WORD.findall(text.lower())):
                    if w not in known:
                        known[w] = bool(wanted[zlib.crc32(w.encode()) % BITS])
                    if known[w]:
                        counts[w] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
            )

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n_term")).join(terms, "term", "left_semi")


def _same(a: DataFrame, b: DataFrame):
    return (a["sha"] == b["sha"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, sha and text of the documents named by ``keys`` (doc_id, sha), with its other columns."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_sha().alias("sha"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.join(keys, _same(rows, keys)).select(rows["doc_id"], rows["sha"], rows["text"], *[
        keys[c] for c in keys.columns if c not in ("doc_id", "sha")
    ])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, sha and the distinct words of a text that lie in no span."""
    for batch in batches:
        terms = [sorted({m[0].lower() for m in _free(t)}) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(terms, pa.list_(pa.string()))], names=["doc_id", "sha", "terms"]
        )


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, sha and added: the spans of a document's terms that give something away."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        added = []
        for text, told in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            most = {x["term"]: x["d"] for x in told}
            found = [(most[w], *m.span()) for m in _free(text) if (w := m[0].lower()) in most]
            added.append([{"kind": ADDED[d < REMOVE], "start": a, "end": b} for d, a, b in found])
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(added, kind)], names=["doc_id", "sha", "added"])


def _added(docs: DataFrame, detected: DataFrame) -> DataFrame | None:
    """doc_id, sha and added: the spans of terms that give an entity of their document away.

    None if no entity stands in enough passages to have such terms.
    """
    near = detected.select("doc_id", "sha", F.explode("near").alias("w")).select("doc_id", "sha", "w.entity", "w.term", "w.window")
    # Documents with each entity, with one passage that stands for all words far from it.
    placed = stored(near.groupBy("doc_id", "sha", "entity").agg(F.min("window").alias("window")))
    able = stored(
        near.select("entity", "window").distinct().groupBy("entity").agg(F.count("*").alias("windows"))
        .where(F.col("windows") >= SUPPORT).select("entity")
    )
    if able.isEmpty():
        return None
    entities = placed.groupBy("entity").agg(F.count("*").alias("n_entity")).join(able, "entity")
    held = stored(placed.join(entities, "entity"))
    keys = held.select("doc_id", "sha").distinct()
    terms = stored(
        _texts(docs, keys).dropDuplicates(["doc_id", "sha"]).mapInArrow(_terms, "doc_id long, sha binary, terms array<string>")
        .select("doc_id", "sha", F.explode("terms").alias("term"))
    )
    frequencies = stored(_document_frequencies(docs, terms.select("term").distinct()))
    n = docs.count()
    known = terms.join(frequencies, "term")
    # n(t, e) is at most n(e), so a term in too many documents cannot reach the threshold with e.
    rest = float(n) ** (1 - GENERALISE)
    possible = F.col("n_term") <= F.pow("n_entity", F.lit(GENERALISE)) * rest * (1 + 1e-9)
    both = stored(known.join(held, _same(known, held) & possible).select(
        known["doc_id"], known["sha"], "entity", "term", "window", "n_term", "n_entity"
    ))
    pairs = both.groupBy("entity", "term", "n_term", "n_entity").agg(F.count("*").alias("n_pair"))
    passages = (
        both.select("entity", "term", "window")
        .unionByName(near.where("term IS NOT NULL").join(able, "entity", "left_semi").select("entity", "term", "window"))
        .distinct().groupBy("entity", "term").agg(F.count("*").alias("windows")).where(F.col("windows") >= SUPPORT)
    )
    value = F.log(F.col("n_pair") * n / (F.col("n_term") * F.col("n_entity"))) / F.greatest(
        F.log(F.lit(float(n)) / F.col("n_entity")), F.lit(1e-9)
    )
    told = (
        pairs.join(passages, ["entity", "term"]).select("entity", "term", F.least(value, F.lit(1.0)).alias("disclosure"))
        .where(F.col("disclosure") >= GENERALISE)
    )
    most = both.join(told, ["entity", "term"]).groupBy("doc_id", "sha", "term").agg(F.max("disclosure").alias("d"))
    marked = stored(most.groupBy("doc_id", "sha").agg(F.collect_list(F.struct("term", "d")).alias("told")))
    return _texts(docs, marked).dropDuplicates(["doc_id", "sha"]).mapInArrow(
        _occurrences, f"doc_id long, sha binary, added {_SPANS}"
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, sha, base and spans (base and added ones, by start, then kind) of every row.

    Null texts are empty. Rows that repeat doc_id and text count as one document in n(t, e) and n(e)
    and get the same spans. Texts of any length are searched whole. Other columns are ignored, an empty
    table gives no rows.
    """
    detected = stored(detect(docs))
    added = _added(docs, detected)
    rows = detected.drop("near")
    if added is None:
        return rows.select("doc_id", "sha", "base", F.col("base").alias("spans"))
    added = added.withColumnsRenamed({"doc_id": "_id", "sha": "_sha"})
    match = (F.col("sha") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    both = F.concat("base", F.coalesce("added", F.expr(f"cast(array() as {_SPANS})")))
    rank = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(F.lit, range(len(KINDS)))))
    keyed = F.transform(both, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(added, match, "left").select("doc_id", "sha", "base", ordered.alias("spans"))


def _text(spans: str):
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans as text of every row; see ``find``."""
    found = find(docs)

    def many(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[many(k) for k in BASE], F.sha2(_text("base").cast("binary"), 256).alias("base_sha256"), _text("spans").alias("spans")
    )


def clean(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind, generalised words by their shape, removed ones by
    nothing. Of spans that overlap, the first one's kind stands for all."""
    out, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            out.append(text[end:a])
            word = text[a:b]
            shape = "[Name]" if word[:1].isupper() else "[word]"
            out.append({"removed": "", "generalised": shape}.get(kind, f"[{kind.upper()}]"))
        end = max(end, b)
    return "".join(out) + text[end:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and what gives it away taken out of the text.

    n_chars, where there is such a column, becomes the new length of the changed texts. Other columns,
    whatever their names, and the texts without spans stay as they are, nulls too. Repeated rows stay
    repeated, texts of any length are taken whole, an empty table gives no rows.
    """
    own, sha, key, spans, renewed = free_names(docs, "own_id", "own_sha", "text_sha", "own_spans", "new_text")
    changed = find(docs).where(F.size("spans") > 0).select(
        F.col("doc_id").alias(own), F.col("sha").alias(sha), F.col("spans").alias(spans)
    ).dropDuplicates([own, sha])
    told = docs.withColumn(key, text_sha())
    match = (F.col(key) == F.col(sha)) & docs["doc_id"].eqNullSafe(F.col(own))

    @F.pandas_udf("string")
    def cleaned(texts, spans):
        return texts.combine(spans, lambda t, s: None if t is None else clean(t, [(x["kind"], x["start"], x["end"]) for x in s]))

    found = told.join(changed, match, "left")
    # Texts without spans do not travel.
    new = cleaned(F.when(F.col(spans).isNotNull(), F.col("text")), F.col(spans))
    found = found.withColumn(renewed, new)
    values = {"text": F.coalesce(renewed, "text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col(renewed).isNotNull(), F.length(renewed).cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*[values.get(c, F.col(c)).alias(c) for c in docs.columns])
