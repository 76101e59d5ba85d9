from factloom.llm import licences


def plain_distance(a, b):
    best = len(a)
    for i in range(len(b)):
        row = list(range(len(a) + 1))
        for w in b[i:]:
            now = [row[0] + 1]
            for j, x in enumerate(a):
                now.append(min(row[j + 1] + 1, now[j] + 1, row[j] + (x != w)))
            row = now
            best = min(best, row[-1])
    return best


def test_differences_equal_plain_dynamic_programming():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, n))] for n in (8, 14))
        assert licences.differences(a, b) == plain_distance(a, b)


def test_every_template_is_found_in_prose_and_with_one_change():
    own = licences.Scanner()
    filler = "some words of prose that go on for a while and mean little " * 30
    for name, text in licences.TEMPLATES:
        assert own.scan(f"{filler}\n{text}\n{filler}")[1] == [(name, 0)]
        assert [x[0] for x in own.scan(f"{filler} {text} {filler}")[1]] == [name]
    assert own.scan("The licence of poets is a warrant for nothing; permission denied.")[1] == []
    assert own.scan("Licensed under CC BY-NC 4.0.\nx\nReleased under the MIT License.")[1] == [("CC-BY-NC-4.0", 0), ("MIT", 0)]
    assert own.scan("This work is licensed under the GNU Lesser General Public License, version 3.")[1] == [("LGPL-3.0", 0)]


def test_edges(spark):
    rows = [(1, None, "a"), (1, "", "b"), (None, "Released under the MIT License. " * 3, "c"), (2, "word " * 50000 + "released under the mit license", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, licenses string")
    got = sorted([tuple(r) for r in licences.scan(df).collect()], key=str)
    assert got == sorted([(1, 0, 0, "", 0), (1, 0, 0, "", 0), (None, 1, 1, "MIT", 0), (2, 1, 1, "MIT", 0)], key=str)
    assert licences.scan(df.limit(0)).count() == 0


def test_several_licences_on_one_line():
    from itertools import permutations

    own = licences.Scanner()
    assert own.scan("Released under the MIT License. Licensed under CC BY 4.0.") == (1, [("MIT", 0), ("CC-BY-4.0", 0)])
    for (a, x), (b, y) in permutations(licences.TEMPLATES, 2):
        assert dict(own.scan(f"{x} {y}")[1]) == {a: 0, b: 0}
    every = " or ".join(x for _, x in licences.TEMPLATES)
    assert dict(own.scan(every)[1]) == {name: 0 for name, _ in licences.TEMPLATES}
    assert own.scan(every.replace("free of charge", "free of any charge").replace("Released under the MIT License. or ", ""))[1][-1] == ("MIT", 1)


def test_wrapped_notices_are_found():
    import textwrap

    own = licences.Scanner()
    for name, text in licences.TEMPLATES:
        for width in (72, 40, 25):
            lines = textwrap.wrap(text, width)
            for mark in ("", "# ", " * ", "// ", "dnl ", "REM "):
                for end in ("\n", "\r\n"):
                    notice = end.join(mark + x for x in lines)
                    assert {x[0] for x in own.scan(f"/*{end}{notice}{end}*/{end}int main;")[1]} == {name}, notice


def test_query_equals_brute_force(spark, tmp_path):
    """Texts of notices with words changed among prose: of each notice the wording of the least share of edits, by plain dynamic programming."""
    import random

    rng = random.Random(7)
    prose = lambda: " ".join(rng.choice(["river", "stone", "table", "quiet", "morning", "seven"]) for _ in range(rng.randint(150, 260)))
    rows, want = [(-1, None), (-2, "")], {-1: (0, "", 0), -2: (0, "", 0)}
    wordings = [(name, licences.plain(text)) for name, text in licences.TEMPLATES]
    for i in range(30):
        text, names, edits = prose(), [], 0
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(licences.TEMPLATES)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = "other"
            block = licences.plain(" ".join(words))
            fits = [(d / len(w), -len(w), name, d) for name, w in wordings if (d := plain_distance(w, block)) <= int(0.15 * len(w))]
            if fits and any(licences.re.search(licences.CUES, w) for w in block):
                best = min(fits)
                # A longer wording of the same license around it stands instead.
                longer = min([x for x in fits if x[2] == best[2] and x[1] < best[1]], key=lambda x: (x[1], x[0]), default=best)
                names.append(best[2])
                edits += longer[3]
            text += "\n" + " ".join(words) + "\n" + prose()
        rows.append((i, text))
        want[i] = (len(names), ",".join(sorted(set(names))), edits)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_confirmed"], r["licenses"], r["n_differences"]) for r in licences.op8_licences(spark, str(tmp_path)).collect()}
    assert got == want


def test_savings_name_a_place_and_word_differences_confirm_it(monkeypatch):
    own = licences.Scanner()
    full = [x for name, x in licences.TEMPLATES if name == "BSD-3-Clause"][-1]
    # The two clauses within stand without a change; the whole saves more.
    for holder, n in (("Example University", 3), ("the Example Institute of Technology", 4)):
        assert own.scan(full.replace("the copyright holder", holder))[1] == [("BSD-3-Clause", n)]
    for i, (_, text) in enumerate(licences.TEMPLATES):
        assert own.read(licences.plain(text)) == i
    # What compresses best but is no wording of the place names nothing; the next that word differences confirm does.
    label = lambda text: own.templates[own.read(licences.plain(text))][0]
    monkeypatch.setattr(own, "saved", lambda words: [{"MIT": 9, "GPL-3.0": 5}.get(name, 0) for name, _ in own.templates])
    own.named.clear()
    assert label("Licensed under CC BY 4.0.") == "CC-BY-4.0"
    assert label(licences._SHORT.format("General Public License", "2")) == "GPL-3.0"
