"""Notices as they stand in files: wrapped, behind comment marks."""

import random
import re
from re import _parser

import pytest

from pulsegrid.llm import licence_scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """
3. Neither the name of Foo Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU {}General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version."""
NOTICES = {MIT: "MIT", BSD_2: "BSD-2-Clause", BSD_3: "BSD-3-Clause", APACHE: "Apache-2.0",
           GPL.format(";", "", ";", "2"): "GPL-2.0-or-later", GPL.format(":", "", ",", "3"): "GPL-3.0-or-later",
           GPL.format(";", "Lesser ", ";", "2.1"): "LGPL", GPL.format(":", "Affero ", ",", "3"): "AGPL-3.0"}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices(mark):
    for notice, licence in NOTICES.items():
        wrapped = "\n".join((mark + line).rstrip() for line in notice.split("\n"))
        text = f"é🙂 prose\n\n{wrapped}\n\nint x;\n"
        (start, stop, name), = licence_scan.licences(text)
        assert (name, text[start:stop]) == (licence, wrapped.strip())


def test_lines_stay_notices_of_their_own():
    def names(text):
        return [x for _, _, x in licence_scan.licences(text)]

    assert names("some prose\nReleased under the MIT License\nmore prose. And more.") == ["MIT"]
    assert names("Copyright 2020 Foo\nAll rights reserved\nReleased under the\nMIT License.") == [
        "unmatched:copyright", "unmatched:all-rights", "MIT"]
    assert names("/* SPDX-License-Identifier: MIT */\n# SPDX-License-Identifier: 0BSD") == ["MIT", "0BSD"]
    assert names("This work is licensed under the GNU General Public\n# License, version 3.\n#\n# Also this. Any later version.") == [
        "GPL-3.0-only", "unmatched:later"]


def members(parsed, rnd):
    """A random text that a parsed regular expression matches."""
    out = ""
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(value)
        elif op == "ANY":
            out += rnd.choice("xyz ")
        elif op == "IN":
            kind, x = rnd.choice(value)
            out += chr(x) if str(kind) == "LITERAL" else rnd.choice("0123456789") if "DIGIT" in str(x) else rnd.choice("abz")
        elif op == "MAX_REPEAT":
            least, most, inner = value
            out += "".join(members(inner, rnd) for _ in range(rnd.randint(least, min(most, least + 3))))
        elif op == "SUBPATTERN":
            out += members(value[3], rnd)
        elif op == "BRANCH":
            out += members(rnd.choice(value[1]), rnd)
        else:
            raise ValueError(op)
    return out


def test_prefilter_keeps_every_form():
    rnd = random.Random(8)
    for name, pattern in licence_scan.SENTENCES:
        for _ in range(300):
            text = members(_parser.parse(pattern), rnd)
            assert re.fullmatch(pattern, text), name
            assert licence_scan.KEYWORD.search(text.replace(" ", rnd.choice([" ", "\n# ", "-", "_"]))), (name, text)


def test_creative_commons_without_the_word_licence():
    assert [x for _, _, x in licence_scan.licences("Released under CC BY-SA 4.0.")] == ["CC-BY-SA-4.0"]
    assert [x for _, _, x in licence_scan.licences("This work is released under Creative Commons BY 4.0.")] == ["CC-BY-4.0"]
