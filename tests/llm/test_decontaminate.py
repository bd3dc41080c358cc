import pyarrow as pa
from conftest import SF_SMALL, rows_of

from taxograde.llm import decontaminate as D

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def contained(doc, item):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    q = grams(item)
    if 0 < len(item.split() if item else []) < 5:
        short, w = item.lower().split(), (doc or "").lower().split()
        return float(any(w[i:i + len(short)] == short for i in range(len(w) - len(short) + 1)))
    return len(q & grams(doc)) / len(q) if q else 0.0


def brute(docs, items):
    return sorted((d, i) for d, t in docs for i, x in items if contained(t, x) >= 0.8)


def pairs(df):
    return sorted((r["doc_id"], r["item_id"]) for r in rows_of(df))


def test_table_equals_brute_force(spark, documents):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert pairs(D.contained_items(documents, items)) == want and want
    # several blocks of items give the same pairs
    assert pairs(D.contained_items(documents, items, block_chars=1000)) == want
    left = {r["doc_id"] for r in rows_of(D.without_items(documents, items, block_chars=1000))}
    assert left == {r.doc_id for r in documents.collect()} - {d for d, _ in want}


def test_edits_and_long_documents(spark):
    long = "filler " * 70_000
    docs = [(1, long + ITEM + " " + long), (2, ITEM.replace("twelve", "x")), (3, ITEM.replace("six", "x")),
            (4, ITEM.upper()), (5, " ".join(ITEM.split()[:7]))]
    items = [(10, ITEM), (11, "short item"), (12, None), (13, ""), (10, ITEM), (None, ITEM)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(D.contained_items(df, it))
    assert {r["doc_id"] for r in got} == {1, 2, 4} and len(got) == 9
    assert {r["containment"] for r in got if r["doc_id"] == 2} == {7 / 8}


def test_recall_at_the_threshold():
    """Signatures alone miss almost no passage at containment 0.8."""
    import random
    rng = random.Random(1)
    miss = 0
    for n in (6, 9, 17, 33, 60, 100):
        items = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n + 4)) for _ in range(60)]
        index = D.build_index(list(range(60)), items)
        docs = [" ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(200)) + " " + " ".join(x.split()[:int(0.8 * n) + 5]) for x in items]
        doc, h = D.S.shingles(pa.array(docs), short=False)
        count = D.np.bincount(doc, minlength=60)
        found = set(zip(*[x.tolist() for x in D._candidates(h, D.np.cumsum(count) - count, count, index)]))
        miss += sum((i, i) not in found for i in range(60))
    assert miss <= 2


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    assert pairs(D.contained_items(awkward, items)) == [(-7, 1), (1, 1), (1, 1)]
    assert D.without_items(awkward, items).columns == awkward.columns and D.without_items(awkward, items).count() == 6
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contained_items(awkward, none).count() == 0 and D.without_items(awkward, none).count() == 9
    assert D.contained_items(empty, items).count() == 0


def test_items_of_under_five_words(spark, tmp_path):
    """One to four words are one shingle; with longer items, repeated rows, and as the only items."""
    import random

    import pyarrow.parquet as pq
    from oracle_check import digest, duck_rows
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))) for i in range(80)] + [(90, ITEM), (91, None), (92, "a")]
    short = [(1, "A b c d"), (2, "h g"), (3, "a"), (4, "zz"), (5, " c\td\n e "), (6, "b b b b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for items in (short, [*short, (10, ITEM), (11, None), (12, "")]):
        it = spark.createDataFrame(items, "item_id long, text string")
        want = brute(docs, items)
        assert pairs(D.contained_items(df, it)) == want and len(want) > 100
        assert pairs(D.contained_items(df, it, block_chars=10)) == want
        assert {r["doc_id"] for r in rows_of(D.without_items(df, it))} == {d for d, _ in docs} - {d for d, _ in want}
    pq.write_table(df.toArrow(), tmp_path / "documents.parquet")
    pq.write_table(it.toArrow(), tmp_path / "benchmark.parquet")
    got = D.contained_items(df, it)
    cols, rows = duck_rows(str(tmp_path), D.ORACLE)
    assert digest([tuple(r) for r in got.collect()], got.columns)[0] == digest(rows, cols)[0]
    twice = spark.createDataFrame(short[:2] * 2, "item_id long, text string")
    assert pairs(D.contained_items(df, twice)) == sorted(brute(docs, short[:2]) * 2)
