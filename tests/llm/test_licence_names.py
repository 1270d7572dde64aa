"""Further licences by header and by name, and the query against a plain search of the given texts."""

import os
import random
import re

import pytest

from pulsegrid.llm import licence_scan

SF = "/root/testdata/sf0.01"
# --- fixed values: public licence notices ---
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
BOOST = """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at
https://www.boost.org/LICENSE_1_0.txt)"""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
UNLICENSE = "This is free and unencumbered software released into the public domain."
# --- end of fixed values ---
NOTICES = {MPL: "MPL-2.0", ISC: "ISC", BOOST: "BSL-1.0", EPL: "EPL-2.0", UNLICENSE: "Unlicense"}
NAMES = {"MIT License": "MIT", "Mozilla Public License 2.0": "MPL-2.0", "Mozilla Public License, version 2.0": "MPL-2.0",
         "ISC License": "ISC", "Boost Software License 1.0": "BSL-1.0", "Unlicense": "Unlicense", "zlib License": "Zlib",
         "Eclipse Public License v1.0": None, "Eclipse Public License, Version 1.0": "EPL-1.0",
         "BSD 3-Clause License": "BSD-3-Clause", "BSD 2-Clause \"Simplified\" License": "BSD-2-Clause",
         "3-clause BSD license": "BSD-3-Clause", "New BSD License": "BSD-3-Clause", "Apache License 2.0": "Apache-2.0",
         "GNU General Public License, version 3": "GPL-3.0-only", "GNU Affero General Public License, version 3": "AGPL-3.0"}
TAILS = ("", ".", " - see the LICENSE file for details.", " - see the [LICENSE](LICENSE) file for details.",
         ", see LICENSE.md", "; see the accompanying COPYING file for more information.")


def names(text):
    return [x for _, _, x in licence_scan.licences(text)]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_headers(mark):
    for notice, licence in NOTICES.items():
        wrapped = "\n".join((mark + line).rstrip() for line in notice.split("\n"))
        text = f"prose é\n\n{wrapped}\n\nint x;\n"
        (start, stop, name), = licence_scan.licences(text)
        # a bracket that closes after the last word is no part of a sentence's words, but of its stretch
        assert (name, text[start:stop]) == (licence, wrapped.strip())


def test_recall_of_names_written_and_wrapped():
    rnd = random.Random(4)
    wanted = found = 0
    for name, licence in NAMES.items():
        for tail in TAILS:
            for lead in ("Licensed under the ", "This project is licensed under the ", "Released under the terms of the "):
                words = f"{lead}{name}{tail}".split(" ")
                cut = rnd.randint(1, len(words) - 1)
                for text in (" ".join(words), " ".join(words[:cut]) + "\n" + " ".join(words[cut:])):
                    wanted += licence is not None
                    found += licence is not None and names(f"prose before\n\n{text}\n\nprose after") == [licence]
    assert found >= 0.97 * wanted, (found, wanted)


def test_what_is_no_licence():
    for text in ("the new bsd system was released under the bridge", "mozilla is a name", "a licence to kill", "warranties expire",
                 "MPL", "the boost was 1.0", "see the LICENSE file for details"):
        assert names(text) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_query_equals_a_plain_search(spark):
    """What stands in the given texts are four sentences, written on lines of their own."""
    forms = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    found = re.compile("|".join(re.escape(f) for f in forms), re.IGNORECASE)
    spelled = {f.lower(): name for f, name in forms.items()}
    got = {r.doc_id: r for r in licence_scan.op6(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        places = [f"{spelled[m.group().lower()]}:{m.start()}:{m.end()}" for m in found.finditer(r.text or "")]
        known = [x for x in got[r.doc_id].notices.split(",") if x and not x.startswith("unmatched:")]
        assert known == places, r.doc_id
