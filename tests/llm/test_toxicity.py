import math
import random
import zlib

from conftest import rows_of

from taxograde.llm import toxicity as T

SF_LARGE = "/root/testdata/sf0.1"  # fewer labels give no lexicon


def test_folding():
    assert T.fold("1D10T") == "idiot" and T.fold("ѕсum") == "scum" and T.fold("ｔｒａｓｈ") == "trash"
    assert T.fold("call 1234 or 5ee") == "call 1234 or see" and T.fold("cl@wn") == "clawn"
    assert len(T.fold("Ünï ½ 3x")) == len("Ünï ½ 3x")


def planted(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = ["".join(rng.choice("bcdfgh") + rng.choice("aeu") for _ in range(3)) for _ in range(30)]
        if toxic:
            words[10:10] = [["moron", "m0r0n", "мoron"][i // 4 % 3]]
        elif i % 4 == 1:
            words[5:5] = ["oxy", "moron"]  # an innocent phrase
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_lexicon_exceptions_and_held_out_accuracy(spark):
    docs, labels = planted(spark)
    lexicon = T.learn(docs, labels.where(T.fold_of(T.F.col("doc_id")) != 0))
    assert any("moron".startswith(e) for e in lexicon.weights) and "oxy moron" in lexicon.exceptions
    got = {r["doc_id"]: r["score"] >= 0.5 for r in rows_of(T.score(docs, lexicon))}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and all(got[i] == (i % 4 == 0) for i in held)
    scores = [r["score"] for r in rows_of(T.score(docs, lexicon))]
    assert all(0 <= s <= 1 for s in scores)


def test_length_normalises():
    lexicon = T.Lexicon({"moron": 3.0}, slope=1.0, offset=0.0)
    assert lexicon.density("moron " + "a " * 10) > lexicon.density("moron " + "a " * 1000) > 0 == lexicon.density("oxymoron")


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 0), (None, 1), (3, None), (2, 1), (5, 1), (4, 0), (5, 0)], "doc_id long, toxic int")
    lexicon = T.learn(awkward, labels)
    got = rows_of(T.score(awkward, lexicon))
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert T.learn(empty, labels).weights == {} and T.learn(awkward, labels.where("false")).weights == {}
    assert {r["score"] >= 0.5 for r in rows_of(T.score(awkward, T.learn(empty, labels)))} == {False}


def plain_fold(text):
    """Folding letter by letter."""
    text = text.lower()
    if any("\u0370" <= c <= "\u052f" or "\uff01" <= c <= "\uff5e" for c in text):
        text = "".join(chr(ord(c) - 0xFEE0) if "\uff01" <= c <= "\uff5e" else c for c in text).lower()
        text = "".join(chr(T.HOMOGLYPHS.get(ord(c), ord(c))) for c in text)
    out, i = "", 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in "0123456789@$":
            j += 1
        if j == i:
            out, i = out + text[i], i + 1
            continue
        inside = i > 0 and text[i - 1].isalpha() or j < len(text) and text[j].isalpha()
        out += "".join(chr(T.DIGITS.get(ord(c), ord(c))) for c in text[i:j]) if inside else text[i:j]
        i = j
    return out


def letters(text):
    """Maximal runs of letters, as (start, end)."""
    out, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and T._WORD.fullmatch(text[j]):
            j += 1
        if j > i:
            out.append((i, j))
        i = max(j, i + 1)
    return out


def plain_density(lexicon, text):
    """Every entry looked for at the beginning of every word, without an automaton."""
    text = plain_fold(text or "")
    total = 0.0
    for a, z in letters(text):
        if a and text[a - 1].isalpha():
            continue
        for entry, weight in lexicon.weights.items():
            if text[a:a + len(entry)] != entry:
                continue
            before, after = letters(text[max(0, a - 40):a]), letters(text[z:z + 40])
            near = [text[max(0, a - 40):a][x:y] + " " + text[a:z] for x, y in before[-1:]]
            near += [text[a:z] + " " + text[z:z + 40][x:y] for x, y in after[:1]]
            total += 0.0 if any(n in lexicon.exceptions for n in near) else weight
    return total / math.sqrt(10 + sum(c == " " for c in text)) if total else 0.0


def test_scores_equal_a_plain_matcher(spark):
    """The query's scores, from a matcher that tries each entry at each word: every toxic document and a share of the others."""
    documents = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    lexicon = T.learn(documents, labels.where(T.fold_of(T.F.col("doc_id")) != 0))
    got = {r["doc_id"]: r for r in rows_of(T.op4_folded_lexicon(spark, SF_LARGE))}
    assert lexicon.weights and len(got) == documents.count()
    some = [i for i, r in got.items() if r["predicted"] or i % 40 == 0]
    hits = 0
    for r in documents.where(T.F.col("doc_id").isin(some)).select("doc_id", "text").collect():
        x = plain_density(lexicon, r["text"])
        want = 1 / (1 + math.exp(-min(50.0, max(-50.0, lexicon.slope * x + lexicon.offset))))
        mine = got[r["doc_id"]]
        assert abs(mine["score"] - want) < 1e-9 and mine["predicted"] == (want >= 0.5)
        assert mine["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        hits += x > 0
    assert hits > 50
    docs, marks = planted(spark)
    lexicon, by_id = T.learn(docs, marks), {r["doc_id"]: r["text"] for r in rows_of(docs)}
    for r in rows_of(T.score(docs, lexicon)):
        assert abs(r["density"] - plain_density(lexicon, by_id[r["doc_id"]])) < 1e-9
