"""Operator 3: homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (here: pieces between line ends and
sentence marks, trimmed). SHA-256 turns each piece into a wide vector, and a
fingerprint is the sum of the vectors, lane by lane modulo a power of two:
equal multisets have equal fingerprints in any order, and adding or removing a
piece adds or subtracts its vector (``plus``, ``minus``). A vector has

* 8 dense lanes modulo 2^30, cut from the digest, which decide equality, and
* ``LEVELS`` x ``LANES`` sparse lanes modulo 2^14, of which a piece touches one:
  its level (each takes a quarter of what the last one left), its lane and its
  amount follow from other bits of the digest.

Two dense lanes, or four sparse ones, lie in one 64-bit word with guard bits
between them, so that one addition and one mask add them all.

Likeness is the share of equal sparse lanes among those that either fingerprint
uses: a lane agrees when the pieces that fell into it are the same, and the
thinned levels still tell long texts apart. Built from DataFrame functions only.

Nulls and edges: a null text is empty; an empty text, or one of separators
only, has the fingerprint of zeros, and two such are alike (1). A row's next
document is the row with the next smaller doc_id (after the smallest: the
largest); of rows that share a doc_id the smallest text counts as the next, and
a single document is its own next. Rows with null doc_id have no next: nothing
is put in the place of the removed third, and ``near_next`` is 0. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, table

LANES, LEVELS = 16, 4
DENSE, WORDS = 4, 20  # words of the dense lanes, all words
DENSE_MASK, DENSE_GUARD = 0x3FFFFFFF3FFFFFFF, 0x4000000040000000
SPARSE_MASK, SPARSE_GUARD = 0x3FFF3FFF3FFF3FFF, 0x4000400040004000
SEPARATORS = "[\\n.?;|]+"
#: Ids per group of the ordering, and per group of groups: 2^12 each.
_SPAN = 4096


def pieces(text: Column) -> Column:
    """Digests of the trimmed, non-empty pieces of a text."""
    parts = F.filter(F.transform(F.split(text, SEPARATORS), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(parts, lambda p: F.sha2(p, 256))


def vector(digests: Column) -> Column:
    """The sum of the vectors of ``digests``: WORDS words, dense lanes first."""
    numbers = F.transform(digests, lambda d: F.struct(*[
        F.conv(F.substr(d, F.lit(15 * j + 1), F.lit(15)), 16, 10).cast("long").alias(f"x{j}") for j in range(DENSE)]))
    # bits 0-3 of x3: lane; each next two bits: stop at this level unless both are zero
    level = (lambda x: F.when(x.bitwiseAND(0x30) != 0, 0).when(x.bitwiseAND(0xC0) != 0, LANES)
             .when(x.bitwiseAND(0x300) != 0, 2 * LANES).otherwise(3 * LANES))
    placed = F.transform(numbers, lambda n: F.struct(
        *[F.shiftleft(F.shiftright(n[f"x{j}"], 30), 32).bitwiseOR(n[f"x{j}"].bitwiseAND(0x3FFFFFFF)).alias(f"x{j}")
          for j in range(DENSE)],
        (level(n["x3"]) + n["x3"].bitwiseAND(LANES - 1)).cast("int").alias("lane"), n["x0"].bitwiseAND(0x3FFF).alias("amount")))
    cells = F.transform(placed, lambda p: F.struct(
        *[p[f"x{j}"].alias(f"x{j}") for j in range(DENSE)], F.shiftright(p["lane"], 2).alias("word"),
        (p["amount"] * F.element_at(F.array(*[F.lit(1 << 16 * k).cast("long") for k in range(4)]), p["lane"] % 4 + 1)).alias("add")))
    n_sparse = WORDS - DENSE

    def total(cells_):  # applied by a transform of one element, which binds the array once
        def dense(j):
            return F.aggregate(cells_, F.lit(0).cast("long"), lambda acc, c: (acc + c[f"x{j}"]).bitwiseAND(F.lit(DENSE_MASK)))
        rest = F.aggregate(
            cells_, F.array_repeat(F.lit(0).cast("long"), n_sparse),
            lambda acc, c: F.concat(F.slice(acc, F.lit(1), c["word"]),
                                    F.array((F.element_at(acc, c["word"] + 1) + c["add"]).bitwiseAND(F.lit(SPARSE_MASK))),
                                    F.slice(acc, c["word"] + 2, F.lit(n_sparse))))
        return F.concat(F.array(*[dense(j) for j in range(DENSE)]), rest)
    return F.element_at(F.transform(F.array(cells), total), 1)


def _masked(v: Column, i: Column) -> Column:
    return v.bitwiseAND(F.when(i < DENSE, F.lit(DENSE_MASK)).otherwise(F.lit(SPARSE_MASK)))


def plus(a: Column, b: Column) -> Column:
    """Fingerprint vector of the union of two multisets."""
    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p, i: _masked(p["x"] + p["y"], i))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint vector after the pieces of ``b`` are removed from ``a``."""
    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p, i: _masked(
        p["x"] + F.when(i < DENSE, F.lit(DENSE_GUARD)).otherwise(F.lit(SPARSE_GUARD)) - p["y"], i))


def to_string(v: Column) -> Column:
    """Lower-case hexadecimal, 16 digits a word."""
    return F.lower(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def sparse(v: Column) -> Column:
    """The words of the sparse lanes."""
    return F.slice(v, DENSE + 1, WORDS - DENSE)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal lanes among the sparse lanes (words ``a``, ``b``) that either uses."""
    lanes = [0x3FFF << 16 * k for k in range(4)]
    either = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)), F.lit(0), lambda acc, x: acc + sum(
        F.when(x.bitwiseAND(F.lit(m)) != 0, 1).otherwise(0) for m in lanes))
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda acc, x: acc + sum(
        F.when(x.bitwiseAND(F.lit(m)) != 0, 1).otherwise(0) for m in lanes))
    return F.when(either == 0, 1.0).otherwise((either - differ).cast("double") / either)


def previous_ids(scratch: Scratch, ids: DataFrame) -> DataFrame:
    """``ids(id, n)`` -> (id, before, n_before): the next larger id and its n, cyclically.

    Ids are grouped by ``_SPAN``; a window runs inside each group, and the least
    id of a group finds its successor among the groups, which are grouped in
    turn, until at most two are left. No window ever covers more than 2 * _SPAN rows.
    """
    edge = ids.agg(F.min(F.struct("id", "n")).alias("lo"), F.max("id").alias("hi")).first()
    if edge["hi"] is None:
        return ids.select("id", F.col("id").alias("before"), F.col("n").alias("n_before"))
    found = _before(ids.select(F.col("id").alias("key"), F.struct("id", "n").alias("it")), edge["lo"]["id"], edge["hi"])
    first = F.struct(F.lit(edge["lo"]["id"]).cast("long").alias("id"), F.lit(edge["lo"]["n"]).cast("long").alias("n"))
    found = found.withColumn("up", F.coalesce("up", first))
    return scratch.stage(found.select(F.col("it.id").alias("id"), F.col("up.id").alias("before"), F.col("up.n").alias("n_before")),
                         "before")


def _before(rows: DataFrame, lo: int, hi: int) -> DataFrame:
    """``rows(key, it)`` with ``up``: the ``it`` of the next larger key, null for the largest."""
    if hi // _SPAN - lo // _SPAN <= 1:  # at most two groups (0 and -1 never meet)
        return rows.withColumn("up", F.lead("it").over(Window.partitionBy(F.lit(0)).orderBy("key")))
    group = F.expr(f"cast(floor(key / cast({_SPAN} as decimal(20,0))) as bigint)")
    rows = rows.withColumn("group", group)
    rows = rows.withColumn("up", F.lead("it").over(Window.partitionBy("group").orderBy("key")))
    groups = rows.groupBy("group").agg(F.min_by("it", "key").alias("it")).withColumnRenamed("group", "key")
    after = _before(groups, lo // _SPAN, hi // _SPAN).select(F.col("key").alias("group"), F.col("up").alias("next_up"))
    return rows.join(after, "group").select("key", "it", F.coalesce("up", "next_up").alias("up"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses."""
    scratch = Scratch(docs.sparkSession, "multiset_hash")
    # a bigint id is taken as it is: an alias would keep the two exchanges below from being one
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    texts = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))
    known = rows = texts.where("doc_id is not null")
    # of the rows of one id, the longest cut decides how much of the next text is handed on
    ids = scratch.stage(known.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.length("text")).cast("long").alias("n"),
                                                                       F.count(F.lit(1)).alias("rows")), "ids")
    if not ids.where("rows > 1").isEmpty():
        known = known.groupBy("doc_id").agg(F.min("text").alias("text"))
    before = previous_ids(scratch, ids.select("id", "n")).withColumnRenamed("id", "doc_id")
    heads = known.join(before, "doc_id").select(
        F.col("before").alias("doc_id"), F.substr("text", F.lit(1), F.floor(F.col("n_before") / 3).cast("int")).alias("head"),
        sparse(vector(pieces(F.col("text")))).alias("next_lanes"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    # both joins deal the same rows by doc_id: one exchange of the texts serves them
    own = rows.join(heads, "doc_id", "left").unionByName(texts.where("doc_id is null"), allowMissingColumns=True)
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.coalesce(F.substr("head", F.lit(1), cut), F.lit("")))
    own = own.select("doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_lanes")
    own = own.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "next_lanes",
                     vector(pieces(F.col("text"))).alias("v"), vector(pieces(F.col("edited"))).alias("e"))
    return own.select("doc_id", "n_chars", "edited_sha256", to_string(F.col("v")).alias("fingerprint"),
                      to_string(F.col("e")).alias("edited_fingerprint"),
                      likeness(sparse(F.col("v")), sparse(F.col("e"))).alias("near_edited"),
                      F.coalesce(likeness(sparse(F.col("v")), F.col("next_lanes")), F.lit(0.0)).alias("near_next"))


def op3_multiset_hash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))


ORACLE = """
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
cut AS (SELECT *, text[1:n - n // 3] || next_text[1:n // 3] AS edited FROM base),
texts AS (SELECT doc_id, 'own' AS kind, text FROM cut UNION ALL SELECT doc_id, 'edited', edited FROM cut),
digests AS (
  SELECT doc_id, kind, sha256(trim(p)) AS h
  FROM texts, unnest(string_split_regex(text, '[\n.?;|]+')) AS u(p) WHERE trim(p) <> ''),
numbers AS (
  SELECT doc_id, kind, j, ('0x' || substr(h, 15 * j + 1, 15))::BIGINT AS x,
         ('0x' || substr(h, 1, 15))::BIGINT AS x0, ('0x' || substr(h, 46, 15))::BIGINT AS x3
  FROM digests, range(4) AS r(j)),
dense AS (
  SELECT doc_id, kind, j AS word, (((sum(x >> 30) % 1073741824)::BIGINT << 32) + (sum(x & 1073741823) % 1073741824)::BIGINT) AS v
  FROM numbers GROUP BY ALL),
sparse AS (
  SELECT doc_id, kind, CASE WHEN x3 & 48 <> 0 THEN 0 WHEN x3 & 192 <> 0 THEN 16 WHEN x3 & 768 <> 0 THEN 32 ELSE 48 END + (x3 & 15) AS lane,
         (sum(x0 & 16383) % 16384)::BIGINT AS amount
  FROM numbers WHERE j = 0 GROUP BY ALL),
words AS (
  SELECT doc_id, kind, word, v FROM dense
  UNION ALL
  SELECT doc_id, kind, 4 + lane // 4, sum(amount << (16 * (lane % 4)))::BIGINT FROM sparse GROUP BY ALL),
strings AS (
  SELECT t.doc_id, t.kind, string_agg(printf('%016x', coalesce(w.v, 0)), '' ORDER BY j) AS f
  FROM texts t CROSS JOIN range(20) AS r(j)
  LEFT JOIN words w ON w.doc_id = t.doc_id AND w.kind = t.kind AND w.word = j GROUP BY ALL),
lanes AS (
  SELECT t.doc_id, t.kind, j::BIGINT AS lane, coalesce(s.amount, 0)::BIGINT AS amount
  FROM texts t CROSS JOIN range(64) AS r(j) LEFT JOIN sparse s ON s.doc_id = t.doc_id AND s.kind = t.kind AND s.lane = j),
pairs AS (
  SELECT c.doc_id, 'edited' AS other, a.amount AS x, b.amount AS y
  FROM cut c JOIN lanes a ON a.doc_id = c.doc_id AND a.kind = 'own'
  JOIN lanes b ON b.doc_id = c.doc_id AND b.kind = 'edited' AND b.lane = a.lane
  UNION ALL
  SELECT c.doc_id, 'next', a.amount, b.amount
  FROM cut c JOIN lanes a ON a.doc_id = c.doc_id AND a.kind = 'own'
  JOIN lanes b ON b.doc_id = c.next_id AND b.kind = 'own' AND b.lane = a.lane),
near AS (
  SELECT doc_id, other, CASE WHEN count(*) FILTER (x <> 0 OR y <> 0) = 0 THEN 1.0
         ELSE count(*) FILTER (x = y AND x <> 0) / (count(*) FILTER (x <> 0 OR y <> 0))::DOUBLE END AS likeness
  FROM pairs GROUP BY doc_id, other)
SELECT c.doc_id, c.n AS n_chars, sha256(c.edited) AS edited_sha256, o.f AS fingerprint, e.f AS edited_fingerprint,
       ne.likeness AS near_edited, nn.likeness AS near_next
FROM cut c JOIN strings o ON o.doc_id = c.doc_id AND o.kind = 'own'
JOIN strings e ON e.doc_id = c.doc_id AND e.kind = 'edited'
JOIN near ne ON ne.doc_id = c.doc_id AND ne.other = 'edited'
JOIN near nn ON nn.doc_id = c.doc_id AND nn.other = 'next'
"""
