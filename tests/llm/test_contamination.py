import random

import duckdb

from terroir.llm import contamination as c
from terroir.llm.queries import DECONTAMINATION_SQL

SEED = random.Random(4)
ITEMS = "item_id long, text string, doc_id string"


def words(n):
    return [f"w{SEED.randint(0, 5000)}" for _ in range(n)]


def brute(pairs, items, similarity=0.8):
    out = set()
    for item, text in items:
        wanted = set(c.shingle_list(text or ""))
        for doc, body in pairs:
            found = wanted & set(c.shingle_list(body or ""))
            if wanted and len(found) * 10 >= round(similarity * 10) * len(wanted):
                out.add((doc, item, len(wanted), len(found)))
    return out


def corpus():
    items = [(i, " ".join(words(SEED.randint(5, 60)))) for i in range(40)]
    items += [(40, "two words"), (41, ""), (42, None), (None, items[3][1]), (43, items[3][1])]
    pairs = []
    for i in range(80):
        body = words(SEED.randint(0, 400))
        if i % 2:
            part = (SEED.choice(items[:40])[1]).split()
            for _ in range(SEED.randint(0, 3)):
                part[SEED.randrange(len(part))] = "changed"
            at = SEED.randint(0, len(body))
            body[at:at] = part
        pairs.append((i, " ".join(body)))
    return pairs + [(80, "Two, WORDS!"), (81, None), (82, ""), (None, items[7][1].upper()), (5, items[7][1])], items


def test_search_equals_brute_force(spark, documents):
    pairs, items = corpus()
    benchmark = spark.createDataFrame([(*x, "x") for x in items], ITEMS)
    expected = brute(pairs, items)
    assert len(expected) > 15
    for size in (c.BLOCK_CHARS, 500):  # one block, many blocks
        rows = c.find_contamination(documents(pairs), benchmark, block_chars=size).collect()
        assert {tuple(r)[:4] for r in rows} == expected and len(rows) == len(expected)


def test_stage_drops_what_search_finds(spark, documents):
    pairs, items = corpus()
    docs, benchmark = documents(pairs), spark.createDataFrame([(*x, "x") for x in items], ITEMS)
    found = {(d, t) for d, t in pairs for e in brute([(d, t)], items)}
    kept = c.decontaminated(docs, benchmark, block_chars=500)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(set(pairs) - found, key=str)


def test_needed_shingles_are_exact():
    block = c.Block([])
    assert [block.needed(n) for n in (1, 4, 5, 10, 15, 100)] == [1, 4, 4, 8, 12, 80]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert c.find_contamination(documents(["a b c d e f"]), none).collect() == []
    assert c.decontaminated(documents(["a b c d e f"]), none).count() == 1
    assert c.find_contamination(documents([]), none).collect() == []


def test_items_under_five_words_are_found_in_long_documents(spark, documents):
    items = [(1, "Quantum Foam"), (2, "answer"), (3, "北京大学"), (4, "北京大学在中国的首都北京"), (5, "four words in all"), (6, "foam quantum")]
    pairs = [
        (0, "a long text that speaks of quantum foam, and then of more"),
        (1, "the answer"), (2, "an answered question of six words"), (3, "quantum and foam are words apart here"),
        (4, "我在北京大学学习了四年时间。"), (5, "他说北京大学在中国的首都北京市里面"), (6, "大学北京, 北京 大 学 apart"),
        (7, "one two Four words, in all six"), (8, "quantum"), (9, None), (10, ""),
    ]
    benchmark = spark.createDataFrame([(*x, "x") for x in items], ITEMS)
    rows = c.find_contamination(documents(pairs), benchmark).collect()
    got = {(r["doc_id"], r["item_id"], r["containment"]) for r in rows}
    # Document 6 has the four characters in order, whatever stands between them.
    assert got == {(0, 1, 1.0), (1, 2, 1.0), (4, 3, 1.0), (5, 3, 1.0), (5, 4, 1.0), (6, 3, 1.0), (7, 5, 1.0)}
    kept = c.decontaminated(documents(pairs), benchmark, block_chars=5).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 3, 8, 9, 10]


def test_statement_with_short_items(spark, documents):
    """Items of one to four words, in scripts with and without spaces, beside longer ones."""
    docs = [
        (1, "Paris is the capital of France and a large city"), (2, "the answer is forty two"), (3, "forty two"), (4, None),
        (5, "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059 Tokyo"), (6, ""), (7, "capital of"), (8, "one two three four five six"),
        (9, "\u0e01\u0e02\u0e04 and Paris"), (10, "a b c d e f g h i j k l m n o " * 2000),
    ]
    items = [
        (1, "Paris"), (2, "forty two"), (3, "\u65e5\u672c"), (4, "capital of France"), (5, "one two three four five six seven"),
        (6, "one two three four five six"), (7, "the answer is forty"), (8, None), (9, "\u0e02"), (10, "b c d e f g"), (11, "!!"),
    ]
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    expected = con.execute(DECONTAMINATION_SQL).fetchall()
    names = [d[0] for d in con.description]
    found = c.find_contamination(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(tuple(r[n] for n in names) for r in found.collect())
    assert got == sorted(expected) and {i for _, i, *_ in got} >= {1, 2, 3, 4, 6, 7, 9, 10}
