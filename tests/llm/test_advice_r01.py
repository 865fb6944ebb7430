
from __future__ import annotations

import random
import textwrap

from quern.llm import decontamination, html_extraction, licenses, line_dedup, secrets


def every_offset(line: str) -> set[str]:
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def test_line_dedup_takes_every_offset(spark):
    r = random.Random(12)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    lines = ["tiny", "tinx", "日本語テキスト" * 3, word(200)]
    lines += ["x" + lines[3], "縦" + "".join(chr(0x4E00 + r.randrange(5000)) for _ in range(60))]
    lines.append(lines[-1][1:])
    for _ in range(40):  # one-character typos
        line = " ".join(word(r.randint(3, 8)) for _ in range(r.choice((8, 12, 20))))
        at = r.randrange(len(line))
        lines += [line, line[:at] + "#" + line[at + 1 :]]
    parent = list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            a, b = every_offset(lines[i]), every_offset(lines[j])
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    want = {i for i in range(len(lines)) if root(i) != i}
    assert len(want) > 30
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {x["doc_id"] for x in line_dedup.dedup_lines(docs).collect() if x["n_dropped"]} == want


def test_decontamination_keeps_the_part_beside_a_clash(spark):
    item = "The train leaves Springfield at 45 km and costs 12 usd while the other train leaves at 45 km sharp today"
    texts = [(1, item.replace("45", "77", 1)), (2, item.replace("45", "77")), (3, item.replace("45 km sharp", "77 km sharp")), (4, "The train leaves Springfield at 45 km and 9 usd"), (5, item.replace("12", "45").replace("45", "77", 1))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for broadcast in (True, False):
        got = {x["doc_id"]: (x["first_word"], x["n_words"], x["n_changed"]) for x in decontamination.contaminated(docs, bench, broadcast=broadcast).collect()}
        assert got == {1: (0, 17, 1), 2: (0, 21, 2), 3: (0, 17, 0), 5: (0, 17, 2)}


def test_decontamination_takes_words_at_starts_and_few_literals(spark):
    short, medium = "What is the boiling point of water", "Which river flows past the old town of Ulm today"
    numbers, long = "Compute 17 23 4 9", "The committee of Ulm met the delegates from Paris near the bridge over the river Rhine today"
    bench = spark.createDataFrame(list(enumerate([short, medium, numbers, long], 1)), "item_id long, text string")
    wrapped = long.replace(" Ulm", "\nUlm").replace(" Paris", "\nParis").replace(" Rhine", "\nRhine")
    texts = [
        (1, "Q 12 " + short + " at sea level", 1), (2, "Q 7 " + medium, 2), (3, "please " + medium.replace("Ulm", "Bonn"), 2), (4, "exercise: compute 17 23 4 9", 3), (5, "some text " + wrapped, 4),
        (6, "Compute 17 23 4 8", None), (7, "How is the boiling point of", None), (8, "Who is the boiling point of water", None), (9, long.upper(), 4),
    ]
    docs = spark.createDataFrame([x[:2] for x in texts], "doc_id long, text string")
    for broadcast in (True, False):
        got = {(x["doc_id"], x["item_id"], x["n_changed"]) for x in decontamination.contaminated(docs, bench, broadcast=broadcast).collect()}
        assert got == {(doc, item, int(doc == 3)) for doc, _, item in texts if item}
    assert decontamination.decontaminate(docs, bench).count() == 3


def extracted(spark, pages: list[tuple[int, str, str]], parts: int = 1) -> dict[int, str]:
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
    return {r["page_id"]: r["text"] for r in html_extraction.main_text(rows).collect()}


def test_html_copies_are_no_neighbours(spark):
    page = "<div>Menu of the site</div><div>Story {0}, as told in plain words, number {0}</div><div>Foot</div>".format
    copies = [(i, f"http{'s' * (i % 2)}://c.example/a?v={i}", page("one")) for i in range(40)]
    others = [(100, "http://c.example/0", page("two")), (101, "http://c.example/b", page("three")), (102, "http://e.example/b", page("four")), (103, "http://e.example/b?x", page("four"))]
    got = extracted(spark, copies + others)
    assert all(got[i] == "Story one, as told in plain words, number one" for i in range(40))
    assert got[100].startswith("Story two") and got[100].endswith("two") and got[101].endswith("number three")
    assert got[102] == got[103] == "Menu of the site\n\nStory four, as told in plain words, number four\n\nFoot"


def test_html_lines_outside_articles_are_at_stake(spark):
    page = "<div>Menu of the site</div><div>Story {0} told outside</div><article><p>Teaser {0}</p><p>Same quote</p></article><div>Foot</div>".format
    got = extracted(spark, [(i, f"http://t.example/{i}", page(i)) for i in range(3)])
    assert got == {i: f"Story {i} told outside\n\nTeaser {i}\n\nSame quote" for i in range(3)}


def test_html_class_words_on_outer_containers():
    def text(html: str) -> list[str]:
        return [t for t, _, bad in html_extraction.lines(html) if not bad]

    assert text('<html class="has-alert"><body class="post-template has-sidebar"><div class="layout-sidebar-right"><article class="post comment-open"><p>Story</p></article></div></body></html>') == ["Story"]
    assert text('<body class="sidebar"><main id="search"><p>Story</p></main></body>') == ["Story"]
    assert text('<div class="ad">x</div><div id="cookie-banner">x</div><div class="box sidebar-inner">x</div><section class="comments">x</section><div class="ad-1">x</div><ul class="related-posts"><li>x</ul><p>Story</p>') == ["Story"]


def test_licenses_in_wrapped_lines():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    found = lambda text: [x[0] for x in licenses.scan(text, scanner)]
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            for width in (24, 40, 72):
                for lead in ("", " * ", "# "):
                    wrapped = "\n".join(lead + x for x in textwrap.wrap(text, width))
                    assert found(f"{lead}Some code\n\n{wrapped}\n\n{lead}1. More of it") == [name], wrapped
    assert found("This work is licensed under the GNU General Public License, version\n3.") == ["GPL-3.0"]
    assert found("A title\nReleased under the MIT License.\nLicensed under CC BY 4.0. Prose.") == ["MIT", "CC-BY-4.0"]


def test_secrets_beside_separators():
    automata = secrets.infer(secrets.labelled_credentials())
    made = {name: values[0] for name, values in secrets.labelled_credentials(1, seed=31).items()}
    made["access_id"] = "ASIA" + made["access_id"][4:]
    for name, value in made.items():
        for left, right in (("GITHUB_PAT=", ""), ("/users/", "/x"), ("stripe=", "-old"), ("key_", "_v2"), ("a/b-c_d=", "")):
            spans = secrets.scan(f"see {left}{value}{right} there", automata)[5]
            at = 4 + len(left)
            if name == "digest":  # the base patterns have it
                assert f"hex:{at}:{at + len(value)}" in spans
            else:
                assert f"format_{name}:{at}:{at + len(value)}" in spans, (left, value, right, spans)
    two = f"{made['prefixed']}/{made['service_key']}"
    assert secrets.scan(two, automata)[3] == 2
    assert not secrets.scan("https/www-example-org/some-long-path/with_many-parts=and_values/ReadMe-2024_final", automata)[5]
