"""Licence notices: planted wordings are found, near ones are told apart, clean texts are left alone."""

import random
import re
import textwrap

import pytest
import zstandard as z

from linkmill.llm.licences import TEMPLATES, LicenceScanner, scan_licences
from linkmill.llm.queries import op6_licences

SCANNER = LicenceScanner()


@pytest.mark.parametrize("licence, text", TEMPLATES)
def test_templates_are_found_inside_other_text(licence, text):
    rng = random.Random(text)
    noise = lambda n: " ".join("".join(rng.choices("etaoin shr".replace(" ", ""), k=5)) for _ in range(n))
    for around in (f"{text}", f"{noise(50)}\n{text}\n{noise(50)}", f"{noise(90)} {text} {noise(90)}"):
        assert [m.licence for m in SCANNER.scan(around)][:1] == [licence]


def test_wordings_that_decide():
    one = lambda t: [m.licence for m in SCANNER.scan(t)]
    assert one("Licensed under the CC BY-NC 4.0 license.") == ["CC-BY-NC-4.0"]
    assert one("This project is licensed under the GNU General Public License, version 2") == ["GPL-2.0"]
    assert one("Licensed under the Apache License, Version 1.1.") == []
    assert one("She renewed her driving license at the public office.") == []
    assert one("Licensed under CC BY 4.0.\nno\nReleased under the MIT License") == ["CC-BY-4.0", "MIT"]


def test_ranking_equals_one_compression_per_template():
    block = "this work is licensed under the gnu general public license version 3"
    alone = len(z.ZstdCompressor(level=9, write_content_size=False).compress(block.encode()))
    want = []
    for i, (_, text) in enumerate(TEMPLATES):
        plain = " ".join(re.findall(r"[^\W_]+(?:\.\d+)*", text.lower())).encode()
        d = z.ZstdCompressionDict(plain, dict_type=z.DICT_TYPE_RAWCONTENT)
        size = len(z.ZstdCompressor(level=9, dict_data=d, write_content_size=False, write_dict_id=False).compress(
            block.encode()))
        want.append((alone - size, -i))
    assert SCANNER.ranked(block) == sorted(want, reverse=True)


def test_query_finds_all_planted_lines(spark):
    folder = "/root/testdata/sf0.01"
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted((r.doc_id, name) for r in docs for line, name in lines.items() if line in r.text)
    got = op6_licences(spark, folder).collect()
    assert sorted((r.doc_id, r.licence) for r in got) == want and want
    texts = {r.doc_id: r.text for r in docs}
    assert all(r.licence in (lines.get(texts[r.doc_id][r.start:r.start + r.length].strip(), r.licence)) for r in got)


def test_odd_rows(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (None, mit), (3, mit), (3, mit), (4, "word " * 200_000 + mit), (5, "license" * 5000),
            (6, "license " * 20_000)]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, licence string, gain int")
    got = sorted(repr((r.doc_id, r.licence)) for r in scan_licences(frame).collect())
    assert got == sorted(["(None, 'MIT')", "(3, 'MIT')", "(3, 'MIT')", "(4, 'MIT')"])
    assert scan_licences(frame.limit(0)).count() == 0


@pytest.mark.parametrize("width", [40, 80])
@pytest.mark.parametrize("licence, text", TEMPLATES)
def test_wrapped_templates_are_found(licence, text, width):
    for mark in ("", "# ", " * ", "    "):
        lines = textwrap.wrap(text, width, initial_indent=mark, subsequent_indent=mark)
        for end in ("\n", "\r\n"):
            around = f"some words before{end}{end}{end.join(lines)}{end}{end}some words after"
            found = SCANNER.scan(around)
            assert [m.licence for m in found] == [licence]
            assert found[0].differences == "" and around[found[0].start:].split()[0].strip("#*") in text


def test_every_notice_of_a_line_is_found():
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    text = f"{apache} {mit}"
    assert [(m.licence, text[m.start:m.start + m.length] + ".") for m in SCANNER.scan(text)] == [
        ("Apache-2.0", apache), ("MIT", mit)]
    shuffled = [t for t in TEMPLATES * 5]
    random.Random(1).shuffle(shuffled)
    for gap in (0, 3, 20, 70):
        between = " ".join(["word"] * gap)
        text = f" {between} ".join(t for _, t in shuffled)
        assert [m.licence for m in SCANNER.scan(text)] == [name for name, _ in shuffled]
    text = " ".join(f"{'filler ' * 50}license" for _ in range(40)) + f" {mit} " + "copyright filler " * 40 + apache
    assert [m.licence for m in SCANNER.scan(text)] == ["MIT", "Apache-2.0"]
    turkish = "İ İİ license by İstanbul: " + mit
    assert [(m.licence, turkish[m.start:]) for m in SCANNER.scan(turkish)] == [("MIT", mit)]
