"""Template windows against a plain search, and re-parameterised questions."""

from ebbflow.llm import template_windows as TW

ITEM = ("A train travels 120 miles in 2 hours. At what speed does Alice see it pass when she walks 3 miles "
        "towards the station before noon on the same day?")


def leaks(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.kind for r in TW.leaks(d, i, **kw).collect()}


def test_verbatim_passages_are_found(corpus, spark):
    from conftest import SF_SMALL
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = {(d.doc_id, i.item_id) for d in corpus.collect() for i in items.collect() if i.text in d.text}
    rows = TW.leaks(corpus, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and want
    assert {r.kind for r in rows} == {"verbatim"} and all(r.n_matched >= r.n_windows - 1 for r in rows)
    kept = TW.drop_leaks(corpus, items)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in corpus.collect()} - {d for d, _ in want}
    assert kept.columns == corpus.columns


def test_other_numbers_and_names(spark):
    other = ITEM.replace("120", "75.5").replace("2 hours", "9 hours").replace("Alice", "Bob").replace("3 miles", "4 miles")
    swapped = ITEM.replace("Alice", "Bob")
    # "120" and "3" both become 7: one value for two slots
    mixed = ITEM.replace("120", "7").replace("3 miles", "7 miles")
    got = leaks(spark, [(1, "Some text first. " + ITEM), (2, "before " + other + " after"), (3, swapped), (4, mixed), (5, "a b c " * 50)], [(9, ITEM)])
    assert got == {(1, 9): "verbatim", (2, 9): "reparameterised", (3, 9): "reparameterised"}


def test_partial_copies_need_coverage(spark):
    words = ITEM.split()
    half = " ".join(words[:14])
    assert leaks(spark, [(1, half)], [(9, ITEM)]) == {}
    assert leaks(spark, [(1, half)], [(9, ITEM)], coverage=0.2) == {(1, 9): "verbatim"}


def test_short_items(spark):
    got = leaks(spark, [(1, "they said: what is the capital city here"), (2, "x")], [(1, "What is the capital city?"), (2, "is the"), (3, None), (4, "")])
    assert got == {(1, 1): "verbatim"}


def test_edges(edge_docs, spark):
    items = spark.createDataFrame([(1, "a row without any id but with words"), (None, "another text under the same id as before")], "item_id long, text string")
    rows = TW.leaks(edge_docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(None, 1), (7, None)}
    kept = TW.drop_leaks(edge_docs, items)
    assert kept.count() == edge_docs.count() - 2 and kept.columns == edge_docs.columns
    assert TW.leaks(edge_docs.limit(0), items).count() == 0
    assert TW.drop_leaks(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_repeated_rows_and_repeated_passages(spark):
    text = ITEM + " something else " + ITEM
    rows = TW.leaks(spark.createDataFrame([(1, text), (1, text), (2, ITEM)], "doc_id long, text string"),
                    spark.createDataFrame([(9, ITEM), (10, ITEM)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 9), (1, 10), (2, 9), (2, 10)]


def test_edited_and_partial_copies(spark):
    words = ITEM.split()
    put_in = " ".join(words[:15] + ["quickly"] + words[15:])
    left_out = " ".join(words[:15] + words[16:])
    replaced = " ".join([*words[:9], "velocity", *words[10:20], "toward", *words[21:]])
    most = " ".join(words[:18])
    run = " ".join(f"{ITEM} Then it was said again in other words. {ITEM}".split()[5:22])
    got = leaks(spark, list(enumerate([put_in, left_out, replaced, most])), [(9, ITEM)])
    assert got == {(k, 9): "verbatim" for k in range(4)}
    long = ITEM + " " + " ".join(f"w{k}x" for k in range(60))
    assert leaks(spark, [(1, "so " + run), (2, " ".join(words[:12]))], [(9, long)]) == {(1, 9): "verbatim"}


def test_names_under_both_readings(spark):
    item = "Tom has 3 apples. Jerry has 5 apples. How many apples do Tom and Jerry have in New York?"
    renamed = "Ann has 3 apples. Bob has 5 apples. How many apples do Ann and Bob have in Chicago?"
    docs = [renamed, "a line without a stop " + renamed, "Question " + item, item.lower(),
            item.replace(".", "").replace("?", ""), "So the task is this: how many " + " ".join(renamed.split()[9:]),
            renamed.replace("do Ann", "do Bob").replace("has 3", "has 4").replace("has 5", "has 4")]
    docs.append("Note " + item[:-1] + "?### More")
    got = leaks(spark, list(enumerate(docs)), [(9, item)])
    assert got == {(7, 9): "verbatim", (0, 9): "reparameterised", (1, 9): "reparameterised", (2, 9): "verbatim", (3, 9): "verbatim", (4, 9): "verbatim"}


def test_recall_of_edited_copies(spark):
    """Every item of sf0.1 with one to three words replaced, put in or left out, evenly spaced."""
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    docs, made = [], {}
    for r in items.collect():
        words = r.text.split()
        for kind in ("replaced", "put in", "left out"):
            for edits in (1, 2, 3):
                x = list(words)
                for a in sorted((len(words) * (j + 1) // (edits + 1) for j in range(edits)), reverse=True):
                    x[a:a + (kind != "put in")] = [] if kind == "left out" else [f"zzqx{len(docs)}"]
                made[len(docs)] = (r.item_id, kind, edits)
                docs.append((len(docs), "Nothing of it stands here.\n" + " ".join(x) + "\nNor does it here."))
    found = {(r.doc_id, r.item_id) for r in TW.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    for kind in ("replaced", "put in", "left out"):
        for edits, least in ((1, 0.98), (2, 0.95), (3, 0.8)):
            own = [(k, item) in found for k, (item, *rest) in made.items() if rest == [kind, edits]]
            assert sum(own) / len(own) >= least, (kind, edits, sum(own) / len(own))
