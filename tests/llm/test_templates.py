"""Benchmark items in changed words: other lengths, other case, and items too short for windows."""

from tallyloom.llm import templates

ITEM = (
    "If Mary buys 25 apples at the old market and then gives 3 of them to her brother, how many apples "
    "will be left over for the pie that she wants to bake on the next day for all her friends?"
)
CHANGED = [
    ITEM.replace("25", "twenty five").replace("Mary", "Mary Ann"),
    ITEM.replace("her brother,", "her little brother,"),
    ITEM.replace("the old market", "the very old market").replace("that she wants", "that she really wants"),
    ITEM.upper(),
    ITEM.lower(),
]


def test_changed_items(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM.title()), (3, "Add 3 and 4"), (4, "7 8 9")], "item_id long, text string")
    rows = [(d, f"Some words stand before. {t} And others behind.") for d, t in enumerate(CHANGED)]
    rows += [(10, "add 5 and 6"), (11, "7 8 9"), (12, "7 8 8"), (13, "nothing of the kind is here at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, bench).collect()}
    assert got == {*((d, i) for d in range(len(CHANGED)) for i in (1, 2)), (10, 3), (11, 4)}


def test_words_are_searched_for_glued_units_once(monkeypatch):
    text = "run 5km in 20min, then 3.5 kg of Flour"
    first = templates.read(text)
    assert [a.tolist() for a in first] == [a.tolist() for a in templates.read("run 5 km in 20 min, then 3.5 kg of Flour")]

    class Searches:
        def search(self, word):
            raise AssertionError(word)

    monkeypatch.setattr(templates, "_WITH_UNIT", Searches())
    again = templates.read(text)
    assert [a.tolist() for a in first] == [a.tolist() for a in again]


def test_words_without_digits_are_not_searched_for_numbers(monkeypatch):
    """The patterns are what a word that is met for the first time costs most."""
    known = {w: (n := templates._Words(), n[w], int(n.marks[0]))[2] for w in ("Word,", "end.", "(miles)", "ten!", "5", "3km", "...")}
    plain = ("Word,", "end.", "(miles)", "ten!")
    monkeypatch.setattr(templates, "_WITH_UNIT", None)
    monkeypatch.setattr(templates, "_NUMBER", None)
    for word in plain:
        again = templates._Words()
        assert again.marks[again[word]] == known[word]
    assert known["3km"] & templates._GLUED and not known["5"] & templates._GLUED
