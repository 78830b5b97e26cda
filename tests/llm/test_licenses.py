import textwrap
from pathlib import Path

from pyspark.sql import functions as F

from rollcall.llm import licenses as L

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_own_headers_come_first_then_the_nearest_directory(spark):
    filler = "plain prose of no licence whatever, in the middle of things\n"
    rows = [
        (1, "a/LICENSE", GPL),
        (2, "a/b/x.txt", filler),
        (3, "a/b/c/LICENSE", MIT.upper()),
        (4, "a/b/c/d/e/y.txt", filler * 30),
        (5, "a/b/c/own.txt", filler * 500 + "All rights reserved.\n" + filler),
        (6, "z/none.txt", filler),
        (7, None, filler),
        (8, "a/null.txt", None),
        (9, "top.txt", "Licensed under CC BY-NC 4.0"),
        (10, "ab/x.txt", filler),
        (11, "a/b/c/d/near.txt", "the general public, version by version, uses a license"),
        (2, "a/b/x.txt", filler),
    ]
    rows += [(100 + i, f"bulk/{i}.txt", f"{filler} the work is under way {i}") for i in range(60)]
    files = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, path string, text string, own int, directory string")
    found = L.file_licenses(files, F.col("path").endswith("LICENSE")).collect()
    got = {r["doc_id"]: (r["license"], r["evidence"], r["license_from"]) for r in found}
    assert len(found) == len(rows)
    assert got[1] == ("GPL-3.0", "own", None) and got[2] == ("GPL-3.0", "inherited", "a")
    assert got[3] == ("MIT", "own", None) and got[4] == ("MIT", "inherited", "a/b/c")
    assert got[5] == ("Proprietary", "own", None) and got[6] == (None, None, None) == got[7]
    assert got[8] == ("GPL-3.0", "inherited", "a") and got[9] == ("CC-BY-NC-4.0", "own", None)
    assert got[10] == (None, None, None) and got[11] == ("MIT", "inherited", "a/b/c")
    assert not any(got[100 + i][0] for i in range(60))


def test_the_telling_terms_lose_no_line():
    counts = {t: 10 for texts in L.TEMPLATES.values() for x in texts for t in L.terms(x)} | {"the": 900, "of": 900, "under": 500, "this": 700}
    fitted = L.Templates(L.TEMPLATES, counts, 1000, 0.5)
    words = sorted(counts)
    for i in range(0, len(words) - 6):
        line = " ".join(words[i : i + 6])
        assert (fitted.best(line) is not None) <= bool(fitted.scan(line))


FULL = Path(L.__file__).parent / "license_texts"
COPYRIGHT = "Copyright (c) 2024 Some Widget Makers International Inc."


def wrapped(text, width, mark=""):
    return "\n".join(f"{mark}{line}" for line in textwrap.wrap(" ".join(text.split()), width))


def test_real_licence_files_and_wrapped_notices(spark):
    filler = "".join(f"some line {i} of prose about {i * 7} other things\n" for i in range(40))
    mit, bsd = (FULL / "MIT.txt").read_text(), (FULL / "BSD-3-Clause.txt").read_text()
    gpl, apache = (FULL / "GPL-3.0.txt").read_text(), (FULL / "Apache-2.0.txt").read_text()
    notice = gpl[gpl.index("    This program is free software") : gpl.index("Also add information")]
    licensed = apache[apache.index("   Licensed under the Apache License") :]
    cases = {
        "MIT": [mit, wrapped(mit, 100), f"{COPYRIGHT}\n{mit[mit.index('Permission') :]}", filler + wrapped(mit, 60, "# ") + "\n" + filler],
        "BSD-3-Clause": [bsd, bsd[: bsd.index("3. Neither")], filler + wrapped(bsd, 50, " * ") + "\n" + filler],
        "GPL-3.0": [gpl, wrapped(gpl, 120), wrapped(notice, 60, "// ") + "\n" + filler, f"{COPYRIGHT}\n" + notice.split("\n\n")[0] + "\n" + filler],
        "Apache-2.0": [apache, wrapped(licensed, 70, "# ") + "\n" + filler, f"{COPYRIGHT}\n{licensed}{filler}", filler + apache + filler],
        "Proprietary": [f"{COPYRIGHT} All rights reserved.", f"{COPYRIGHT}\nAll rights reserved.\n" + filler, "Copyright (c) 2024 Acme. All rights reserved.\n" + filler],
        "LGPL-3.0": [notice.replace("GNU General", "GNU Lesser General") + filler],
        "GPL-2.0": [notice.replace("version 3", "version 2") + filler],
        None: [filler, "the permission to copy this program is in the hands of its holders\n" + filler],
    }
    rows = [(name, text) for name, texts in cases.items() for text in texts]
    bulk = [f"{filler} the work is of version {i}, and you may use it as you see fit under the sun" for i in range(60)]
    files = [(i, f"{i}/x.txt", text) for i, text in enumerate([t for _, t in rows] + bulk)]
    found = L.file_licenses(spark.createDataFrame(files, "doc_id bigint, path string, text string"), F.lit(True)).collect()
    got = {r["doc_id"]: r["license"] for r in found}
    assert [got[i] for i in range(len(rows))] == [name for name, _ in rows]
    assert not any(got[i] for i in range(len(rows), len(files)))


def test_a_run_has_the_similarity_of_its_joined_lines():
    counts = {t: 3 + i % 50 for i, t in enumerate(sorted({t for texts in L.TEMPLATES.values() for x in texts for t in L.terms(x)}))}
    fitted = L.Templates(L.TEMPLATES, counts, 1000, 0.75)
    lines = [*(f"word{i} and the other" for i in range(9)), *wrapped(L.TEMPLATES["Apache-2.0"][2], 50, "# ").split("\n"), "more of the same"]
    name, similarity, line, _ = max((m for m in fitted.scan("\n".join(lines)) if m[3] == "header"), key=lambda m: m[1])
    assert (name, line) == ("Apache-2.0", 9)
    assert abs(similarity - fitted.best("\n".join(lines[9:-1]))[0]) < 1e-8


def test_an_empty_table(spark):
    files = spark.createDataFrame([], "doc_id bigint, path string, text string")
    assert L.file_licenses(files, F.lit(True)).count() == 0
