"""Planted passages of whole lines: each goes from all texts but the first that holds it, and nothing else goes."""

import random

from sluicegate.llm import line_chunks


def _line(made, words):
    return " ".join("".join(made.choices("abcdefghij", k=7)) for _ in range(words))


def _planted():
    """Texts of foreign lines with passages of 1 to 10 lines and 51 words or more, some in copies and next to common lines."""
    made = random.Random(5)
    common = [_line(made, 3) for _ in range(4)] + [""]
    passages = [[_line(made, -(-60 // n) + made.randrange(3)) for _ in range(n)] for n in range(1, 11) for _ in range(3)]
    texts = []
    for p in passages:
        for _ in range(3):
            around = [[made.choice(common) if made.random() < 0.4 else _line(made, made.randrange(1, 30)) for _ in range(made.randrange(6))] for _ in range(2)]
            texts.append(around[0] + p + around[1])
    texts += [texts[i] for i in range(0, 90, 9)]
    return passages, texts


def _holds(lines, passage):
    return any(lines[i : i + len(passage)] == passage for i in range(len(lines) - len(passage) + 1))


def test_every_planted_passage_is_found(spark):
    passages, texts = _planted()
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    left = {r["doc_id"]: r for r in line_chunks.dedup(docs).collect()}
    for passage in passages:
        holders = [i for i, t in enumerate(texts) if _holds(t, passage)]
        assert _holds(left[holders[0]]["text"].split("\n"), passage)
        assert not any(line in left[i]["text"].split("\n") for i in holders[1:] for line in passage)
    often = {}
    for t in texts:
        for line in t:
            often[line] = often.get(line, 0) + 1
    for i, t in enumerate(texts):
        assert (left[i]["n_lines"], left[i]["n_removed"]) == (len(t), len(t) - len(left[i]["text"].split("\n")) * (left[i]["text"] != "" or left[i]["n_removed"] < len(t)))
        stays = left[i]["text"].split("\n")
        assert all(line in stays for line in t if often[line] == 1)


def test_short_repeats_stay(spark):
    made = random.Random(6)
    footer, long = _line(made, 20), _line(made, 50)
    texts = [f"{_line(made, 60)}\n{footer}\n{_line(made, 60)}" for _ in range(5)] + [f"{long}\n{footer}", f"{long}\nother"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in line_chunks.dedup(docs).collect()}
    assert [left[i] for i in range(6)] == texts[:6] and left[6] == "other"


def test_names_and_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, long, 1, 2), (3, long, 1, 2), (3, long, 1, 2), (4, long, 1, 2), (5, None, 1, 2), (6, "", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, id int")
    found = line_chunks.dedup(docs)
    assert found.columns == ["doc_id", "text", "n_lines", "id", "_n_lines", "n_removed"]
    got = sorted(((r["doc_id"] or 0, r["text"], r["_n_lines"], r["n_removed"]) for r in found.collect()), key=repr)
    assert got == sorted([(0, long, 1, 0), (3, "", 1, 1), (3, "", 1, 1), (4, "", 1, 1), (5, None, 0, 0), (6, "", 1, 0)], key=repr)
    assert line_chunks.dedup(docs.limit(0)).count() == 0


def test_one_row_twice_is_one_text(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")
    assert [r["text"] for r in line_chunks.dedup(docs).collect()] == [long, long]
