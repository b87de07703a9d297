import random
import re
from itertools import combinations

from feedmill.llm import decontamination as D


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute_force(docs, items):
    """Every item laid over every text at every place."""
    out = set()
    for i, t in docs:
        w = words(t)
        for k, x in items:
            v = words(x)
            if len(v) < D.LEAST_WORDS or i is None or k is None:
                continue
            best = max(((sum(0 <= s + j < len(w) and w[s + j] == v[j] for j in range(len(v))), -s) for s in range(-len(v), len(w))), default=(0, 0))
            if best[0] / len(v) >= D.OVERLAP:
                out.add((i, k, -best[1], best[0]))
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(rng.choice([8, 12, 14, 15, 40, 60])))) for k in range(20)] + [(20, "too short"), (21, None), (None, "x " * 30)]
    docs = []
    for i in range(80):
        w = [word() for _ in range(rng.randint(0, 200))]
        if i % 2:
            v = items[rng.randrange(20)][1].upper().split()
            for _ in range(rng.choice([0, 1, len(v) // 8]) if len(v) > 14 else 0):
                v[rng.randrange(len(v))] = word()
            a = rng.randint(0, len(w))
            w[a:a] = v[: rng.choice([len(v), len(v), len(v) - 1])]
        docs.append((i, ", ".join(w)))
    docs += [(90, None), (91, ""), (None, items[0][1]), (92, docs[1][1]), (1, docs[1][1])]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.n_match) for r in D.contamination(d, b).collect())
    want = brute_force(docs, items)
    assert got == want and len(want) > 30
    bad = {i for i, *_ in want}
    left = D.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(map(str, range(30))))], "item_id long, text string")
    assert D.contamination(d.where("doc_id > 1"), b).count() == 0
    assert D.contamination(d, b.where("item_id > 1")).count() == 0
    assert D.drop_contaminated(d, b).count() == 1


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in D.contamination(d, b).collect()}


def test_replaced_and_put_in_words_at_every_place(spark):
    """2 to 4 replaced words of 15 to 24, 2 or 3 of 8, and one put-in word: nothing is lost, as all shares are over OVERLAP."""
    items = {n: [f"w{n}x{j}" for j in range(n)] for n in (8, *range(15, 25))}
    docs = []
    for n, v in items.items():
        for r in (2, 3, 4) if n > 8 else (2, 3):
            for places in combinations(range(n), r):
                docs.append((len(docs) * 100 + n, " ".join("other" if j in places else x for j, x in enumerate(v))))
        docs += [(len(docs) * 100 + i * 1000000000 + n, " ".join([*v[:i], "other", *v[i:]])) for i in range(1, n)]
    assert found(spark, docs, [(n, " ".join(v)) for n, v in items.items()]) == {(i, i % 100) for i, _ in docs}


def test_words_on_shifted_diagonals_add_up(spark):
    v = [f"w{j}" for j in range(45)]
    long = [f"x{j}" for j in range(59)]
    twice = [*"abcdefghij", *"abcdefghij", *"klmnopqrst"]
    noise = [f"n{j}" for j in range(300)]
    docs = {
        1: [*noise[:9], *v[:15], "put", *v[15:30], "in", *v[30:], *noise[9:]],  # two put-in words: 15/45 on each diagonal
        2: v[:15] + v[16:30] + v[31:],  # two dropped words
        3: [*noise[:50], *long[:29], *noise[50:]],  # a long passage, less than half
        4: [*noise[:50], *long[40:], *noise[50:]],  # 19 words are too few
        5: [*v[:15], *noise[:200], *v[15:30], *noise[200:], *v[30:]],  # not nearby
        6: [*noise[:50], *"abcdefghij", *noise[50:]],  # 10 words of 30, which lie on two diagonals
        7: v[30:] + v[15:30] + v[:15],  # out of order: the longest part is 15 of 45
    }
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(v)), (2, " ".join(long)), (3, " ".join(twice))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.n_match) for r in D.contamination(d, b).collect())
    assert got == [(1, 1, 9, 45), (2, 1, 0, 43), (3, 2, 50, 29)]
    assert sorted(r.doc_id for r in D.drop_contaminated(d, b).collect()) == [4, 5, 6, 7]


def test_recall_over_the_whole_range(spark):
    """10 to 50 % of the words of items of 8 to 60 replaced at random: 0.97 are found at every length and share."""
    rng = random.Random(11)
    items = {n: [f"w{n}x{j}" for j in range(n)] for n in (8, 9, 11, 12, 14, 15, 17, 19, 20, 21, 24, 30, 45, 60)}
    docs, of = [], {}
    for n, v in items.items():
        for share in (0.1, 0.2, 0.3, 0.4, 0.5):
            for _ in range(60):
                gone = set(rng.sample(range(n), int(n * share)))
                of[len(docs)] = (n, share)
                docs.append((len(docs), " ".join(["before"] * rng.randint(0, 5) + ["other" if j in gone else x for j, x in enumerate(v)] + ["after"])))
    got = found(spark, docs, [(n, " ".join(v)) for n, v in items.items()])
    hits = {}
    for i, key in of.items():
        hits[key] = hits.get(key, 0) + ((i, key[0]) in got)
    assert min(hits.values()) >= 58 and len(got) == sum(hits.values())


def test_short_items_are_found_in_full_alone(spark):
    items = [(1, "Alpha"), (2, "alpha beta"), (3, "one two three, four five six seven"), (4, "...")]
    docs = [(1, "x alpha y"), (2, "alpha, BETA"), (3, "so one two three four five six seven eight"), (4, "one two three x five six seven"), (5, "beta alph a")]
    assert found(spark, docs, items) == {(1, 1), (2, 1), (2, 2), (3, 3)}


def test_the_filter_grows_with_the_seeds(spark):
    from pyspark.sql import functions as F

    few, many = (D._filter_of(spark.range(n).select(F.xxhash64("id").alias("seed"))) for n in (10, 20_000))
    assert len(few) * 8 == 1 << 16 and len(many) * 8 == 1 << 22 and 0.08 < (many != 0).mean() < 0.2


def test_a_very_long_text(spark):
    item = " ".join(f"bench{k}" for k in range(30))
    docs = [(1, "word other " * 200_000 + item + " tail" * 1000), (2, "word other " * 200_000)]
    assert found(spark, docs, [(1, item)]) == {(1, 1)}
