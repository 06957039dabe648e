"""Licence notices in the forms in use: SPDX lines, wrapped headers, titles, full texts; versions and variants apart."""

from tidemark.llm import licenses

MIT = licenses.MIT + licenses.MIT_KEEP + "\n\n" + licenses.AS_IS.strip()
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version {v} of the License, or
# (at your option) any later version.
import os
"""
FORMS = {
    "spdx/mit.py": ("# SPDX-License-Identifier: MIT\nimport os", "MIT"),
    "spdx/apache.c": ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
    "spdx/other.c": ("// SPDX-License-Identifier: Zlib\nint x;", None),
    "gpl/two.py": (GPL.format(v=2), "GPL-2.0"),
    "gpl/three.py": (GPL.format(v=3), "GPL-3.0"),
    "apache/LICENSE": ("                                 Apache License\n                           Version 2.0, January 2004\n"
                       "                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE\n", "Apache-2.0"),
    "mit/LICENSE": ("MIT License\n\nCopyright (c) 2019 Some One\n\n" + MIT, "MIT"),
    "bsd/LICENSE": ("Copyright (c) 2019, Some One\nAll rights reserved.\n\n" + licenses.BSD + licenses.BSD_AS_IS, "BSD-2-Clause"),
    "cc/by.txt": ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    "cc/sa.txt": ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
    "cc/nc.txt": ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
}


def test_usual_forms(spark):
    noise = [(f"n/{i}.py", f"the licensee number {i} pays the licence fee") for i in range(40)]
    files = spark.createDataFrame([(p, t) for p, (t, _) in FORMS.items()] + noise, "path string, text string")
    got = {r["path"]: r["license"] if r["origin"] == "own" else None for r in licenses.scan(files).collect()}
    assert {p: got[p] for p in FORMS} == {p: n for p, (_, n) in FORMS.items()}
    assert all(got[p] is None for p, _ in noise)


def test_licence_file_at_the_root(spark):
    files = spark.createDataFrame([("LICENSE", "Released under the MIT License."), ("src/a.py", "code"), ("b.py", "code"), ("src/x/c.py", "code"),
                                   ("/abs/d.py", "code")], "path string, text string")
    got = {r["path"]: (r["license"], r["origin"], r["licensed_by"]) for r in licenses.scan(files).collect()}
    assert got["LICENSE"] == ("MIT", "own", None)
    assert got["src/a.py"] == got["b.py"] == got["src/x/c.py"] == ("MIT", "inherited", "")
