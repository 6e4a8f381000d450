from cadenza.llm import decontamination as dc

ITEMS = [
    (1, "A train leaves Boston at 60 km per hour and arrives after 3 hours, how far did it go?"),
    (2, "Six words make this short item"),
    (3, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (4, "tiny item"), (5, None), (6, ""),
    (7, "If Anna gives Peter 5 apples and Peter gives Anna 5 pears then who has more fruit today"),
]
CLEAN = "Nothing to see in this ordinary document about trains and hours of walking by the sea."
DOCS = [
    (10, f"Intro text. {ITEMS[0][1]} And more."),
    (11, "So: a train leaves Boston at 75 km per hour and arrives after 4 hours, how far did it go!"),
    (12, "six WORDS make, this short item"),
    (13, "alpha*** beta*** gamma*** delta*** epsilon*** zeta*** eta*** theta*** iota*** kappa*** lambda*** mu*** nu***"),
    (14, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (15, CLEAN), (16, None), (17, ""), (18, CLEAN), (18, CLEAN),
    (19, "Say if Maria gives Tom 8 apples and Tom gives Maria 8 pears then who has more fruit today"),
    (20, "Say if Maria gives Tom 8 apples and Tom gives Lisa 9 pears then who has more fruit today"),
    (None, ITEMS[2][1]), (21, "filler " * 30_000 + ITEMS[2][1]), (22, "a tiny item"),
]
SCHEMA = "doc_id long, text string, item_id string"


def found(spark, rows, items):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    return dc.matched(docs, bench).collect()


def test_finds_copies_and_reparameterised_ones(spark):
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in found(spark, DOCS, ITEMS)}
    assert got == {
        (10, 1, False), (11, 1, True), (12, 2, False), (13, 3, False), (19, 7, True),
        (None, 3, False), (21, 3, False),
    }


def test_shuffled_join_and_items_without_seeds(spark, monkeypatch):
    items = [*ITEMS, (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    rows = [
        *DOCS, (30, "21 22 23 24 25 26 27 28 29 30 31 32 33 34"),
        (31, "so 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"),
    ]
    # The same numbers are a copy, as many others are none.
    want = {(r.doc_id, r.item_id) for r in found(spark, DOCS, ITEMS)} | {(31, 8)}
    monkeypatch.setattr(dc, "MOST_BROADCAST", 0)
    assert {(r.doc_id, r.item_id) for r in found(spark, rows, items)} == want


def test_stage_and_query(spark, written, documents):
    folder = written(
        documents=(DOCS, "doc_id long, text string"), benchmark=(ITEMS, "item_id long, text string")
    )
    bad = {r.doc_id for r in dc.op3(spark, folder).collect()}
    assert bad == {10, 11, 12, 13, 19, 21, None}
    docs = documents(*DOCS)
    kept = dc.stage(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [14, 15, 16, 17, 18, 18, 20, 22]
    assert dc.stage(spark, docs.where("false"), folder).count() == 0


def test_no_items(spark):
    assert found(spark, DOCS, [(1, None)]) == []


def test_case_and_punctuation_do_not_hide_a_copy(spark):
    text = "Anna met Peter in Paris. Then Anna, who had 5 apples, gave Peter 3 apples. How many has Anna?"
    copies = [
        text, text.lower(), text.upper(), text.title(), text.translate(str.maketrans("", "", ".,;:!?")),
        text.replace(" ", "\n"), text.replace(". ", " "),
    ]
    other = "Maria met Tom in Rome. Then Maria, who had 8 apples, gave Tom 2 apples. How many has Maria?"
    rows = [(k, c) for k, c in enumerate(copies)]
    rows += [(10, other), (11, other.title()), (12, other.replace(".", ""))]
    got = {(r.doc_id, r.reparameterised) for r in found(spark, rows, [(1, text)])}
    assert got == {(k, False) for k in range(len(copies))} | {(k, True) for k in (10, 11, 12)}


def test_one_edited_value_does_not_hide_equal_windows(spark):
    text = (
        "a shop has 12 red pens and 7 blue pens on a shelf near the door where people walk by every "
        "single morning and later that day the owner counts all of them again and finds 12 red pens left"
    )
    rows = [
        (1, text), (2, text.replace("finds 12", "finds 13")), (3, text.replace("and 7", "and 12")),
        (4, "a shop has 5 red pens and 7 blue pens and finds 12 red pens left"),
    ]
    got = {r.doc_id: r for r in found(spark, rows, [(1, text)])}
    assert set(got) == {1, 2, 3}
    whole = got[1].n_windows
    assert got[1].n_matched == whole == len(text.split()) - 7
    assert got[2].n_matched == whole - 4 and got[3].n_matched == whole - 8
    assert not any(r.reparameterised for r in got.values())


def test_placeholders_alone_match_nothing(spark):
    words = [
        "the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
        "not", "he", "his", "but", "at", "are", "this", "have", "from", "or", "had", "an", "they",
        "which", "one", "you", "were", "all", "her", "she", "there", "would", "their", "we", "him",
    ]
    title = " ".join(w.title() for w in words)
    items = [
        (1, "12 17 23 31 44 58 62 75 81 93 104 117 128"),
        (2, "We saw Rome Paris London Berlin Madrid Vienna Prague Warsaw Lisbon Dublin Athens Oslo Bern"),
        (3, title), (4, "Guests Anna and Peter and Maria and Tom and Lisa and Paul and Eva and Karl"),
    ]
    rows = [
        (1, "99 98 97 96 95 94 93 92 91 90 89 88 87"),
        (2, "We saw Hans Ruth Emil Otto Ida Kurt Anton Frieda Gustav Helga Irma Jonas Klara"),
        (3, " ".join(reversed(words))), (4, " ".join(reversed(words)).title()),
        (5, "Guests Ruth and Emil and Ida and Otto and Kurt and Irma and Hans and Jens"),
        (6, " ".join(words[20:] + words[:20]).upper()),
        (11, f"Numbers: {items[0][1]}."), (12, items[1][1].lower()), (13, title.lower()),
        (14, items[3][1].upper()),
    ]
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in found(spark, rows, items)}
    # Equal words in another order share long runs, which count as such.
    runs = {(6, 3, False)}
    assert got == {(11, 1, False), (12, 2, False), (13, 3, False), (14, 4, False)} | runs
