from __future__ import annotations

import random
import re

from corpora import corpus, edge_rows, edge_table, sentence, table

from ledgerline.llm import decontaminate

ITEM = ("Maria walked to the market and bought 12 apples, then gave 5 apples to her friend Peter who lives 3 km away from "
        "the old river. How many apples of the 12 are left with Maria now?")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, texts, items):
    docs = table(spark, [(i, text, None, None, None) for i, text in enumerate(texts)])
    got = decontaminate.contaminated(docs, benchmark(spark, list(enumerate(items)))).collect()
    return {(row.doc_id, row.item_id): row.changed for row in got}


def test_exact_shouted_and_parameterised_copies(spark):
    rng = random.Random(1)
    around = [sentence(rng, 40) for _ in range(2)]
    other = ITEM.replace("Maria", "Anna").replace("12", "1,250").replace("5 ", "7.5 ").replace("Peter", "Paul").replace("km", "miles")
    broken = ITEM.replace("of the 12", "of the 14").replace("Maria now", "Petra now")
    texts = [f"{around[0]} {ITEM} {around[1]}", f"{around[0]} {other} {around[1]}", " ".join(around), ITEM.replace(".", " ###"),
             around[1], broken]
    got = found(spark, texts, [ITEM, sentence(rng, 30)])
    assert set(got) == {(0, 0), (1, 0), (3, 0), (5, 0)}
    assert got[0, 0] == 0
    assert got[1, 0] >= 5


def test_slots_must_be_consistent(spark):
    """Numbers may differ from the item's, but one number of the item must stay one number."""
    item = "if you add 3 to the sum of these you get the same as 3 times the old sum of all"
    good, bad = item.replace("3", "8"), item.replace("add 3", "add 8").replace("3 times", "9 times")
    assert set(found(spark, [good, bad], [item])) == {(0, 0)}


def test_copies_rich_in_slots(spark):
    """Windows of few plain tokens match word for word, and take no match of the others away."""
    rng = random.Random(4)
    figures = "In table " + " ".join(f"{rng.randrange(900)} km {rng.randrange(90)}" for _ in range(12))
    people = "so asked Peter Paul Mary Anna Karl Otto Emil Frank Clara Hugo Ida"
    mixed = "count how many of the red pens we have 3 4 5 6 7 8 9 10 11 12 13 14 15 16"
    items = ["What is 12 + 7 * 3 - 4?", figures, people, mixed]
    texts = [f"{sentence(rng, 20)}. {item} {sentence(rng, 20)}" for item in items]
    texts += [texts[0].replace("12 + 7", "13 + 7"), " ".join(str(rng.randrange(900)) for _ in range(60)),
              texts[3].replace("have 3 4 5 6", "have 21 22 23 24")]
    assert set(found(spark, texts, items)) == {(0, 0), (1, 1), (2, 2), (3, 3), (6, 3)}


def test_short_items_and_passages(spark):
    rng = random.Random(2)
    long = sentence(rng, 60)
    part = " ".join(long.split(" ")[20:40])
    texts = [f"so we ask why is the sky blue here {sentence(rng, 9)}", f"{sentence(rng, 30)} {part} {sentence(rng, 5)}"]
    assert set(found(spark, texts, ["Why is the sky blue", long, ""])) == {(0, 0), (1, 1)}


def test_like_brute_force_on_plain_words(spark):
    rows = [row for row in corpus(seed=3) if not any(c.isdigit() for c in row[1])]
    rows += [(1000 + i, text, "en", "s", 0) for i, (_, text, *_) in enumerate(corpus(seed=3)[:40])]
    items = [text for _, text, *_ in corpus(seed=3)[:20]]
    def tokens(text):
        out = []
        for m in re.finditer(r"[A-Za-z0-9\u0080-\U0010ffff]+", text):
            word = m.group().lower()
            out.append("#" if word[0].isdigit() else word)
        return out

    got = set(found_rows(spark, rows, items))
    for i, text, *_ in rows:
        for j, item in enumerate(items):
            if text == item and len(tokens(item)) >= 4:
                assert (i, j) in got
    for i, j in got:
        own = tokens(dict((r[0], r[1]) for r in rows)[i])
        theirs = tokens(items[j])
        size = min(8, len(theirs))
        mine = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)}
        assert any(tuple(theirs[k:k + size]) in mine for k in range(len(theirs) - size + 1))


def found_rows(spark, rows, items):
    got = decontaminate.contaminated(table(spark, rows), benchmark(spark, list(enumerate(items)))).collect()
    return [(row.doc_id, row.item_id) for row in got]


def test_edge_cases(spark):
    items = benchmark(spark, [(0, None), (1, ""), (2, "one two three four five"), (None, "a b c d e f g h"), (2, "ONE")])
    docs = edge_table(spark)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    gone = {text for _, text, *_ in edge_rows()} - {row.text for row in kept.collect()}
    # an item of number words alone is all slots and matches nothing
    assert gone == {"a b c d e f g h"}
    none = benchmark(spark, [])
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.drop_contaminated(edge_table(spark, []), items).collect() == []
    assert decontaminate.contaminated(edge_table(spark, []), none).collect() == []


def test_replaced_in_other_words(spark):
    """A slot may get more or fewer words, and one changed slot hides nothing that is equal around it."""
    rng = random.Random(9)
    texts = [ITEM.replace("12", "thirty five"), ITEM.replace("12", "thirty-five"), ITEM.replace("Peter", "Peter van Smith Jones"),
             ITEM.replace("12 apples", "3 million apples").replace("Peter", "Anna Maria"), ITEM.replace("of the 12", "of the 14"),
             ITEM.replace("5 apples", "7 apples").replace("12", "20"), sentence(rng, 60)]
    texts = [f"{sentence(rng, 20)}. {text} {sentence(rng, 20)}" for text in texts]
    assert {i for i, _ in found(spark, texts, [ITEM])} >= {0, 1, 3, 4, 5}
    assert 6 not in {i for i, _ in found(spark, texts, [ITEM])}


def test_long_passage_with_one_contradiction(spark):
    item = ("we take 3 from the jar and put it on the shelf near the wall then we go on to read what it says and after that we "
            "take 3 more from the box and all of it ends up in a bag")
    other = item.replace("take 3 from", "take 8 from").replace("take 3 more", "take 9 more")
    assert set(found(spark, [other, item.replace("3", "8")], [item])) == {(0, 0), (1, 0)}


def windows_of(text):
    """Tokens and values of a text by a regular expression, and its windows, as the module describes them."""
    numbers, units = set(decontaminate.NUMBER_WORDS), set(decontaminate.UNITS)
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+", text)]
    tokens, last_kind, last_end, was_number = [], None, 0, False
    for at, (word, start, end) in enumerate(words):
        low, gap = word.lower(), text[last_end:start]
        number = low[0].isdigit() or low in numbers
        unit = at > 0 and not number and was_number and low in units
        ended = any(c in ".!?:\n" for c in gap)
        name = (at > 0 and not number and not unit and len(word) > 1 and word[0].isupper() and word[1].islower() and not ended)
        kind = "#" if number else "u" if unit else "N" if name else None
        joined = at > 0 and (
            (low[0].isdigit() and words[at - 1][0][0].isdigit() and gap in (".", ","))
            or (low in numbers and was_number and gap in (" ", "-")) or (name and last_kind == "N" and gap == " "))
        if joined:
            tokens[-1] = (tokens[-1][0], tokens[-1][1] + (low,))
        else:
            tokens.append((kind or low, (low,) if kind else ()))
        last_kind, last_end, was_number = kind, end, number
    return tokens


def plain_match(text, item):
    """Whether one alignment of the texts counts, by loops over all shifts."""
    mine, theirs = windows_of(text), windows_of(item)
    size = min(8, len(theirs))
    if not size:
        return False
    def kind(tokens, at, width):
        own = tokens[at:at + width]
        return sum(not values for _, values in own)
    every = [at for at in range(len(theirs) - size + 1) if size == 8 or kind(theirs, at, size)]
    rich = [at for at in every if kind(theirs, at, size) >= min(4, size)]
    for shift in range(-len(theirs), len(mine)):
        for pool in ({True: every, False: rich} if len(rich) < len(every) and rich else {True: every}).values():
            met = {}
            for at in pool:
                if not 0 <= at + shift <= len(mine) - size:
                    continue
                pairs = list(zip(theirs[at:at + size], mine[at + shift:at + shift + size], strict=True))
                same = all(a == b for a, b in pairs)
                if same if at not in rich else all(a[0] == b[0] and bool(a[1]) == bool(b[1]) for a, b in pairs):
                    met[at] = [(a[1], b[1]) for a, b in pairs if a[1]]
            if not met:
                continue
            counts = {}
            for at, pairs in met.items():
                for pair in set(pairs):
                    counts[pair] = counts.get(pair, 0) + 1
            best = {}
            for (was, now), n in counts.items():
                best.setdefault(was, []).append(n)
            against = 0
            for pairs in met.values():
                # a tie between values may fall either way; the cases of the test have none
                against += any(counts[was, now] < max(best[was]) for was, now in pairs)
            equal = sum(all(was == now for was, now in pairs) for pairs in met.values())
            wanted = min(len(pool), 6)
            if (not against and len(met) >= wanted) or equal >= wanted or len(met) - against >= 12:
                return True
    return False


def test_like_brute_force_with_slots(spark):
    rng = random.Random(12)
    names, plain_words = ["Anna", "Peter", "Karl", "Mary Jane"], "he has sold and then gave away of his red old pens to her for".split()

    def some(n):
        return " ".join(rng.choice(plain_words) if rng.random() < 0.75 else rng.choice([*names, "12", "7", "twenty one", "3 km"])
                        for _ in range(n))

    items = [f"So {some(rng.choice((4, 9, 16, 26)))}" for _ in range(12)]
    texts = []
    for item in items:
        texts.append(f"it was {item} or so")
        texts.append(item.replace("12", "35").replace("Anna", "Karl Otto"))
        texts.append(item.replace("12", "12 thousand", 1))
        texts.append(item.replace("7", "8", 1).replace("Peter", "Emil", 1))
        texts.append(" ".join(item.split(" ")[:11]) + " " + some(12))
    texts += [some(40) for _ in range(10)]
    expected = {(i, j) for i, text in enumerate(texts) for j, item in enumerate(items) if plain_match(text, item)}
    assert set(found(spark, texts, items)) == expected


def test_rows_without_an_id_are_documents_of_their_own(spark):
    rows = [(None, f"{ITEM} one", None, None, None), (None, f"{ITEM} two", None, None, None), (None, f"{ITEM} two", None, None, None)]
    assert decontaminate.contaminated(table(spark, rows), benchmark(spark, [(0, ITEM)])).count() == 2
