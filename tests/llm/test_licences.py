"""Licence scan: texts and notices in other spellings."""

from __future__ import annotations

from pathlib import Path

from clearwell.llm import licences as li


def found(df, **options):
    return {(r["doc_id"], r["licence"], r["n_notices"], r["notices"]) for r in li.licences(df, **options).collect()}


def test_texts_and_notices(documents):
    mit = "Copyright (c) 2019 Somebody\n\n" + li.MIT.upper().replace("COPYRIGHT HOLDERS", "Copyright Owners").replace(",", " ;")
    rows = [
        (1, mit), (2, "© 2001 A\n(c) 2002 B\n" + li.ISC), (3, li.BSD_2.replace(" ", "\n")), (4, li.MIT + " and more"),
        (5, "some text\nReleased under the MIT Licence\nother\nlicensed  under cc-by-nc 4.0!"), (6, "Licensed under CC BY 4.0"),
    ]
    assert found(documents(rows)) == {
        (1, "MIT", 0, ""), (2, "ISC", 0, ""), (3, "BSD-2-Clause", 0, ""), (4, None, 0, ""),
        (5, None, 2, "CC-BY-NC-4.0,MIT"), (6, "CC-BY-4.0", 1, "CC-BY-4.0"),
    }


def test_hostile_rows(documents, llm):
    notice = "Released under the MIT License."
    rows = [(1, notice), (1, notice), (2, None), (3, ""), (4, "!!\n--"), (None, notice), (5, "long line " * 20_000)]
    result = li.licences(documents(rows))
    assert result.count() == len(rows)
    assert found(documents(rows)) == {
        (1, "MIT", 1, "MIT"), (2, None, 0, ""), (3, None, 0, ""), (4, None, 0, ""), (None, "MIT", 1, "MIT"), (5, None, 0, ""),
    }
    assert {r["doc_id"] for r in result.where("digest IS NULL").collect()} == {2, 3, 4}
    assert li.licences(documents([])).count() == 0


def test_known_texts_of_ones_own(documents, llm):
    known = li.known_digests(llm, [("Own", "Do as you  wish.")])
    assert found(documents([(1, "do as you WISH"), (2, li.MIT)]), known=known) == {(1, "Own", 1, "Own"), (2, None, 0, "")}


def test_whole_texts_of_the_long_licences(documents):
    folder = Path(li.__file__).with_name("licence_texts")
    text = {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir()}
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"]
    rows = [(i, " ".join(text[name].split(" "))) for i, name in enumerate(names)]
    bsd = "Copyright (c) 2020, A\nAll rights reserved.\n" + li.BSD_3.split("\n", 1)[1].replace("3. N", "* N").replace("2. ", "* ").replace("1. ", "* ")
    apache = text["Apache-2.0"]
    rows += [(20, bsd), (21, text["BSD-3-Clause+regents"]), (22, "The MIT License (MIT)\n" + li.MIT.split("\n", 1)[1])]
    rows += [(23, apache.replace("[yyyy] [name of copyright owner]", "2021 Somebody")), (24, apache[: apache.index("APPENDIX")])]
    rows += [(25, text["GPL-3.0"].upper().replace(",", " ,")), (26, text["GPL-3.0"] + "more")]
    found = {r["doc_id"]: r["licence"] for r in li.licences(documents(rows)).collect()}
    assert found == dict(enumerate(names)) | {
        20: "BSD-3-Clause", 21: "BSD-3-Clause", 22: "MIT", 23: "Apache-2.0", 24: "Apache-2.0", 25: "GPL-3.0", 26: None}


def test_standard_headers(documents):
    gnu = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"
           " as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.")
    rows = [(1, '# code\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not'), (2, "a\n * " + gnu),
            (3, "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;"), (4, "SPDX-License-Identifier: MPL-2.0\nb"),
            (5, "This work is licensed under a Creative Commons Attribution 4.0 International License.\n.c")]
    assert {(r["doc_id"], r["n_notices"], r["notices"]) for r in li.licences(documents(rows)).collect()} == {
        (1, 1, "Apache-2.0"), (2, 1, "LGPL-2.1"), (3, 1, "GPL-2.0"), (4, 1, "MPL-2.0"), (5, 1, "CC-BY-4.0")}
