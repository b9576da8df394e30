from tidepool.llm import decontaminate as dc

from helpers import make_docs


QUESTION = ("A shop sells 12 red apples to Anna for 30 dollars and the rest of the 48 apples go to the market "
            "where Anna pays 30 dollars again for the last ones that are left")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, texts, bench):
    docs = make_docs(spark, [(i, t, "a") for i, t in enumerate(texts)])
    return {(r.doc_id, r.item_id): r for r in dc.report(docs, items(spark, bench)).collect()}


def test_templates_and_slots(spark):
    other = QUESTION.replace("12", "70").replace("Anna", "Maria").replace("30 dollars", "9 euros").replace("48", "144")
    uneven = QUESTION.replace("Anna", "Maria", 1).replace("30", "31", 1)   # one value, two meanings
    got = found(spark, [QUESTION, f"Before it. {other} and after it.", "nothing of the kind here at all, no",
                        QUESTION.upper(), QUESTION[: len(QUESTION) // 2]], [(5, QUESTION)])
    assert {k[0] for k in got} >= {0, 1} and not {2, 4} & {k[0] for k in got}
    assert not got[0, 5].reparameterised and got[1, 5].reparameterised
    assert got[0, 5].coverage == 1.0 and got[1, 5].coverage > 0.8
    few = found(spark, [uneven], [(5, QUESTION)])
    assert not few or few[0, 5].n_matched < got[0, 5].n_matched


def test_slots_alone_are_no_evidence(spark):
    assert not found(spark, ["1 2 3 4 5 6 7 8"], [(1, "9 8 7 6 5 4 3 2")])
    assert (0, 1) in found(spark, ["x 9 8 7 6 5 4 3 2 y"], [(1, "9 8 7 6 5 4 3 2")])


def test_odd_tables(spark, odd_docs, odd_rows, no_docs):
    bench = items(spark, [(1, odd_rows[0][1]), (2, None), (3, ""), (4, "one"), (4, "one"), (None, odd_rows[0][1])])
    rows = dc.report(odd_docs, bench).collect()
    assert {r.doc_id for r in rows if r.item_id == 1} == {1, 2, 3, 4, None}
    assert {r.doc_id for r in rows if r.item_id == 4} == {8}
    left = dc.decontaminate(odd_docs, items(spark, [(1, odd_rows[0][1])]))
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 5
    assert dc.report(no_docs, bench).count() == 0
    assert dc.report(odd_docs, items(spark, [])).count() == 0


def test_against_text_search(spark, sf_dir):
    import re
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def plain(t):
        return " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "

    have = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if plain(b.text) in plain(d.text)}
    got = {(r.doc_id, r.item_id) for r in dc.report(docs, bench).collect()}
    assert have and have == got


def test_names_that_start_sentences(spark):
    tom = "Tom has 5 apples. Anna has 3 apples. How many apples do Tom and Anna have?"
    ben = tom.replace("Tom", "Ben").replace("Anna", "Lisa").replace("5", "8").replace("3", "4")
    got = found(spark, [ben, f'He asked: "{ben}"', ben.replace(". ", ".\n"), tom.replace("Tom", "Apples", 1),
                        "Ben has eight pears. Lisa has none. How many pears do Ben and Lisa have?"], [(7, tom)])
    assert {0, 1, 2} <= {d for d, _ in got} and (4, 7) not in got
    assert got[0, 7].reparameterised and got[0, 7].coverage >= 0.8


def test_each_copy_has_its_own_values(spark):
    q = "the baker sold 12 small loaves 30 large loaves 5 dark loaves 48 rolls to people who came in late that day from far away towns"

    def filled(*v):
        out = q
        for a, b in zip(("12", "30", " 5 ", "48"), v):
            out = out.replace(a, b)
        return out

    one, two = filled("71", "92", " 73 ", "94"), filled("91", "72", " 93 ", "74")
    got = found(spark, [one, f"{one} {two}", f"{two} and {one}. {filled('61', '62', ' 63 ', '64')}",
                        one.replace("to people", "at last to people")], [(3, q)])
    assert {d for d, _ in got} == {0, 1, 2, 3}
    assert {got[d, 3].n_matched for d in (0, 1, 2)} == {got[0, 3].n_matched} and got[3, 3].n_matched < got[0, 3].n_matched


def test_short_items(spark):
    bench = [(1, "purple monkey dishwasher"), (2, "Velvet hammers break blue glass rather often"), (3, "Open sesame"),
             (4, "seven 7 dwarfs")]
    docs = ["he said purple monkey dishwasher and left the room", "it is said, Velvet hammers break blue glass rather often",
            "they cried: open sesame! and it was open", "purple monkey", "seven 8 dwarfs were there in the wood",
            "the seven 7 dwarfs were there in the wood", "Open sesame"]
    assert set(found(spark, docs, bench)) == {(0, 1), (1, 2), (2, 3), (5, 4), (6, 3)}


def _settled(words):
    """Each way to settle the open words of a window, as (template, words)."""
    out = [[]]
    for w in words:
        kinds = [[w]] if not w.startswith(dc.OPEN) else [[w[1:]], [dc.NAME + w[1:]]]
        out = [o + k for o in out for k in kinds]
    return [(tuple(w[0] if w[0] < dc.OPEN else w for w in o),
             tuple(w.translate({ord(s): None for s in dc.SIGNS}) for w in o)) for o in out]


def _meet(a, b):
    """Whether two windows match: a template with enough literal words, or the words."""
    for t, bare in _settled(a):
        for u, other in _settled(b):
            enough = sum(w[0] > dc.OPEN for w in t) >= min(dc.LITERALS, len(t))
            if enough and t == u or not enough and bare == other and sum(
                    w[0] > dc.OPEN for w in u) < min(dc.LITERALS, len(u)):
                return True
    return False


def test_window_matches_equal_all_typings_tried(spark):
    import random
    rng = random.Random(6)
    vocab = ["Tom", "Anna", "has", "12", "apples", "km", "Has", "ran", "7", "and", "How"]

    def text(n):
        return "".join(rng.choice(vocab) + rng.choice([" ", " ", ". ", "! "]) for _ in range(n))

    items = [(k, text(9)) for k in range(12)]
    docs = [(k, text(40) + items[k % 12][1]) for k in range(15)]
    idf = spark.createDataFrame(items, "item_id long, text string")
    ddf = spark.createDataFrame([(k, k, t) for k, t in docs], "_uid long, doc_id long, text string")
    typed = {n: {r[0]: r[1] for r in f.select(f.columns[0], dc.typed_words(f["text"])).collect()}
             for n, f in (("i", idf), ("d", ddf))}
    want = set()
    for d, dw in typed["d"].items():
        for i, iw in typed["i"].items():
            for x in range(len(dw) - 4):
                for y in range(len(iw) - 4):
                    if _meet(iw[y:y + 5], dw[x:x + 5]):
                        want.add((d, i, y, x - y))
    got = {(r["doc_id"], r["item_id"], r["at"], r["shift"]) for r in dc.matches(ddf, idf).collect()}
    assert got == want and len(want) > 50


def test_long_text_and_list_of_names(spark):
    import time
    long = " ".join(("Word" if i % 10 == 0 else f"w{i % 977}") + ("." if i % 10 == 9 else "") for i in range(60_000))
    names = " ! ".join("N" + "abcdefghij"[i % 10] * 2 for i in range(300))
    df = spark.createDataFrame([(1, names), (2, long)], "doc_id long, text string")
    t = time.time()
    rows = {r[0]: r[1] for r in dc.windows(df, ["doc_id"]).groupBy("doc_id").count().collect()}
    assert rows[1] <= 17 * 296 and rows[2] <= 1.6 * 60_000
    assert time.time() - t < 60  # a quadratic expression takes minutes
