"""I-Match document fingerprints over randomised lexicons, with DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band. It is dealt at random into
``SUBSETS`` disjoint lexicons, and thinned to a quarter again and again: level 0 has all of its terms,
level l those whose hash has l zero digits to base 4. A text's signature for a lexicon is the hash of its
distinct terms there, sorted. One whole-lexicon signature changes with any edit; these change only if the
edit touches a term of their own lexicon.

The level fits the text: ``PER_TEXT`` terms or a few more remain, so long and short texts alike have
about one term in each lexicon. The fingerprint holds the signatures at this level and the next thinner
one, so that texts of neighbouring levels compare at the same one. Likeness is the share of equal
signatures among the lexicons where either text has a term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import text_sha
from scholarmill.operators.positions import with_positions
from scholarmill.session import stored

SUBSETS = 32
PER_TEXT = 16
#: Shares of the documents that a term of the lexicon occurs in, at least (and two documents) and at most.
LOW, HIGH = 1 / 2000, 1 / 10
#: Entries of a lexicon that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_TERMS = 2_000_000


def words(text: Column) -> Column:
    """Distinct lower-cased words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Hashes of the terms in the band. Each occurs in a share ``low`` of the documents, so there are at
    most (distinct terms of an average document) / ``low`` of them, however many documents there are."""
    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    n = text.count()
    terms = text.select(F.explode(words(F.col("text"))).alias("w")).select(F.xxhash64("w").alias("term"))
    return stored(
        terms.groupBy("term").agg(F.count("*").alias("df"))
        .where((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n)))
        .select("term")
    )


def _joined(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``rows`` with in_band; the lexicon is broadcast if a count shows that it is small enough."""
    marked = lexicon.withColumn("in_band", F.lit(True))
    fits = lexicon.count() <= BROADCAST_TERMS
    return rows.join(F.broadcast(marked) if fits else marked, "term", "left")


def _signatures(terms: str, level: str) -> Column:
    """Signatures of an array of term hashes at a level; 0 where a lexicon has no term of it."""
    thinned = f"filter({terms}, t -> (t & (shiftleft(1L, 2 * {level}) - 1)) = 0)"
    own = f"filter(kept, t -> pmod(shiftrightunsigned(t, 40), {SUBSETS}) = k)"
    each = (
        f"transform(sequence(0, {SUBSETS - 1}), k -> transform(array({own}), own -> "
        "if(size(own) = 0, 0, cast(shiftrightunsigned(xxhash64(own), 34) as int) + 1))[0])"
    )
    return F.expr(f"transform(array({thinned}), kept -> {each})[0]")


def printed(name: str) -> Column:
    """A fingerprint as text: level, the signatures there and at the next level; or the whole's hash."""
    listed = "array_join(transform({}, s -> if(s = 0, '-', lower(hex(s)))), ' ')"
    return F.expr(
        f"""if({name}_level < 0, concat('w:', lower(hex({name}_whole))),
            concat({name}_level, ':', {listed.format(f'{name}_own')}, '/', {listed.format(f'{name}_next')}))"""
    )


def likeness(a: str, b: str) -> Column:
    """Share of equal signatures among the lexicons where either has a term, 0 to 1.

    Texts without any term in the band are alike only if all of their terms are the same; texts whose
    levels are two or more apart are not alike.
    """
    pairs = f"""filter(zip_with(if({a}_level >= {b}_level, {a}_own, {a}_next),
                                if({b}_level >= {a}_level, {b}_own, {b}_next),
                                (x, y) -> named_struct('x', x, 'y', y)), p -> p.x <> 0 OR p.y <> 0)"""
    share = f"transform(array({pairs}), p -> size(filter(p, q -> q.x = q.y)) / greatest(1, size(p)))[0]"
    return F.expr(
        f"""cast(case when {a}_level < 0 AND {b}_level < 0 then if({a}_whole = {b}_whole, 1, 0)
            when {a}_level < 0 OR {b}_level < 0 OR abs({a}_level - {b}_level) > 1 then 0
            else {share} end as double)"""
    )


def fingerprint_texts(texts: DataFrame, lexicon: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Fingerprints of the text columns ``names``, one row for each ``key``, which is unique.

    Each name gets columns ``_level``, ``_whole``, ``_own`` and ``_next``; other columns stay. Nulls
    count as empty. If ``texts`` is dealt by the key, no row of it moves.
    """
    held = [c for c in texts.columns if c not in (key, *names)]
    listed = texts.select(key, *held, *[words(F.coalesce(n, F.lit(""))).alias(n) for n in names])
    whole = [F.expr(f"aggregate({n}, 0L, (s, w) -> s ^ xxhash64(w))").alias(f"{n}_whole") for n in names]
    payload = [*held, *[f"{n}_whole" for n in names]]
    lists = F.array(*[F.struct(F.lit(i).alias("tag"), F.col(n).alias("words")) for i, n in enumerate(names)])
    tagged = listed.select("*", *whole).select(key, *payload, F.explode(lists).alias("x"))
    # An empty word, which no text has, brings texts without terms to the end.
    rows = tagged.select(key, *payload, "x.tag", F.explode(F.concat(F.array(F.lit("")), "x.words")).alias("w"))
    rows = rows.withColumn("term", F.expr("if(w = '', null, xxhash64(w))"))
    terms = [F.collect_list(F.when((F.col("tag") == i) & F.col("in_band"), F.col("term"))) for i in range(len(names))]
    found = _joined(rows, lexicon).where("in_band OR w = ''").groupBy(key).agg(
        *[F.first(c).alias(c) for c in payload], *[F.array_sort(t).alias(f"{n}_terms") for t, n in zip(terms, names)]
    )
    for n in names:
        size = f"size({n}_terms)"
        level = f"if({size} = 0, -1, greatest(0, cast(floor(log(4, greatest({size}, 1) / {PER_TEXT})) as int)))"
        found = found.withColumn(f"{n}_level", F.expr(level))
        for part, at in (("own", f"greatest(0, {n}_level)"), ("next", f"({n}_level + 1)")):
            found = found.withColumn(f"{n}_{part}", _signatures(f"{n}_terms", at))
    return found.drop(*[f"{n}_terms" for n in names])


def _key() -> Column:
    """doc_id and text as one value that is never null."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"), F.lit(":").cast("binary"), text_sha())


def _neighbours(docs: DataFrame) -> DataFrame:
    """key, doc_id, copies, and of the one before it by falling doc_id to_key and wanted, a third of its
    length.

    Ties of doc_id go by key; a null doc_id comes last; the one before the first is the last one.
    """
    length = F.length(F.coalesce("text", F.lit(""))).cast("long")
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), length.alias("n_chars"))
    once = thin.groupBy("doc_id", "key", "n_chars").agg(F.count("*").alias("copies"))
    placed = stored(with_positions(once, [], [F.col("doc_id").desc_nulls_last(), F.col("key")], "place"))
    last = placed.agg(F.max("place")).first()[0]
    before = placed.select(
        F.col("key").alias("to_key"), F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
        F.when(F.col("place") == F.lit(last), 1).otherwise(F.col("place") + 1).alias("place"),
    )
    return placed.join(before, "place").select("key", "doc_id", "copies", "to_key", "wanted")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    One row for each row of ``docs``. The edited text is the text with its last third replaced by the
    beginning of the next document, by falling doc_id; after the last comes the first. Null texts are
    empty. Rows that repeat doc_id and text count as one document here and have the same values; other
    ties of doc_id go by the text's SHA-256; a null doc_id comes last. Texts of any length move whole, one
    row each. Other columns are ignored, an empty table gives no rows.
    """
    texts = docs.select(_key().alias("key"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["key"])
    # Whole texts move once, by their own key, and beginnings of texts once, to their predecessors. Both
    # uses of the texts read the same columns, so that they share one shuffle.
    own = texts.join(_neighbours(docs), "key")
    graft = own.select(F.col("to_key").alias("key"), F.expr("substring(text, 1, wanted)").alias("graft"))
    n_chars = F.length("text").cast("long")
    whole = own.join(graft, "key").select(
        "key", "to_key", "copies", "doc_id", n_chars.alias("n_chars"), "text",
        F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), "graft").alias("edited"),
    ).withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    prints = stored(fingerprint_texts(whole, lexicon(docs), "key", ["text", "edited"]))
    parts = ("level", "whole", "own", "next")
    after = prints.select(F.col("to_key").alias("key"), *[F.col(f"text_{p}").alias(f"after_{p}") for p in parts])
    each = prints.join(after, "key").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return each.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        printed("text").alias("fingerprint"),
        printed("edited").alias("edited_fingerprint"),
        likeness("text", "edited").alias("near_edited"),
        likeness("text", "after").alias("near_next"),
    )
