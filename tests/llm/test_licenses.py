from barlab.llm.licenses import RULES, SENTENCES, scan_licenses
from tests.llm.conftest import SCHEMA, edge_rows

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. """
THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""


def scanned(spark, *texts):
    df = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], SCHEMA)
    return [r for r in scan_licenses(df).orderBy("doc_id").collect()]


def test_rules_in_order(spark):
    got = scanned(spark, MIT, BSD, BSD + THIRD, "A title\nReleased under the MIT License\nMore", "Licensed under CC BY-NC 4.0.",
                  "prose about the MIT License. Nothing else.", THIRD + " " + BSD)
    assert [r["licenses"] for r in got] == ["MIT", "BSD-2-Clause", "BSD-3-Clause", "MIT", "CC-BY-NC-4.0", "", "BSD-2-Clause"]
    assert [r["restricted"] for r in got] == [False, False, False, False, True, False, False]
    assert got[0]["sentence_ids"] == "4,5"


def test_edges(edge, empty):
    got = scan_licenses(edge).collect()
    assert len(got) == len(edge_rows()) and all(r["licenses"] == "" and r["restricted"] is False for r in got)
    assert {r["doc_id"]: r["n_sentences"] for r in got if r["doc_id"] in (4, 5, 6, 9)} == {4: 0, 5: 0, 6: 0, 9: 1}
    assert scan_licenses(empty).collect() == []


def test_rules_name_known_sentences():
    assert all(1 <= k <= len(SENTENCES) for _, _, run in RULES for k in run)


def test_no_python_in_plan(edge):
    plan = scan_licenses(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


GNU = """    This {0} is free software{1} you can redistribute it and/or modify
    it under the terms of the GNU {2}General Public License as published by
    the Free Software Foundation{3} either version {4} of the License, or
    (at your option) any later version.

    This {0} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {2}General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {}://mozilla.org/MPL/2.0/."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
CC0 = """To the extent possible under law, the author has waived all copyright
and related or neighboring rights to this work."""
CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
NOTICES = [
    ("GPL-2.0-or-later", GNU.format("program", ";", "", ";", "2")), ("GPL-2.0-or-later", GNU.format("program", ";", "", ",", "2")),
    ("GPL-3.0-or-later", GNU.format("program", ":", "", ",", "3")), ("GPL-3.0-or-later", GNU.format("program", ";", "", ";", "3")),
    ("LGPL-2.0-or-later", GNU.format("library", ";", "Library ", ";", "2")),
    ("LGPL-2.1-or-later", GNU.format("library", ";", "Lesser ", ";", "2.1")),
    ("LGPL-2.1-or-later", GNU.format("library", ";", "Lesser ", ",", "2.1")),
    ("LGPL-3.0-or-later", GNU.format("program", ":", "Lesser ", ",", "3")),
    ("LGPL-3.0-or-later", GNU.format("library", ";", "Lesser ", ";", "3")),
    ("AGPL-3.0-or-later", GNU.format("program", ":", "Affero ", ",", "3")),
    ("AGPL-3.0-or-later", GNU.format("program", ";", "Affero ", ";", "3")),
    ("MPL-2.0", MPL.format("https")), ("MPL-2.0", MPL.format("http")), ("Apache-2.0", APACHE), ("ISC", ISC), ("CC0-1.0", CC0),
    ("CC-BY-4.0", CC.format("")), ("CC-BY-SA-4.0", CC.format(" ShareAlike")),
    ("CC-BY-NC-4.0", CC.format(" NonCommercial")), ("MIT", MIT), ("BSD-2-Clause", BSD), ("BSD-3-Clause", BSD + THIRD),
]


def test_official_notices(spark):
    commented = ["".join(f" * {line.strip()}\n" for line in text.splitlines()) for _, text in NOTICES[:13]]
    got = [r["licenses"] for r in scanned(spark, *[text for _, text in NOTICES], *commented)]
    assert got == [name for name, _ in NOTICES] + [name for name, _ in NOTICES[:13]]


BSD_FULL = """Copyright (c) 2015, {0}
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{1}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
CLAUSE = """
3. Neither the name of {0} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
OLD_CLAUSE = """
3. The name of the author may not be used to endorse or promote products
   derived from this software without specific prior written permission.
"""
MIT_FULL = "MIT License\n\nCopyright (c) 2020 Someone. All rights reserved.\n\n" + MIT + """

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
"""
FULL = [
    ("BSD-2-Clause", BSD_FULL.format("Jane Doe", "")), ("BSD-3-Clause", BSD_FULL.format("Jane Doe", CLAUSE.format("the copyright holder"))),
    ("BSD-3-Clause", BSD_FULL.format("Some University", CLAUSE.format("the Some University, its Regents"))),
    ("BSD-3-Clause", BSD_FULL.format("Jane Doe", OLD_CLAUSE)), ("MIT", MIT_FULL),
    ("Apache-2.0", "Copyright 2019 The Authors. All Rights Reserved.\n\n" + APACHE),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more\ncontributor license agreements.  The ASF licenses this\n"
     "file to You under the Apache License, Version 2.0 (the \"License\");\n" + APACHE.split("\n", 1)[1]),
    ("GPL-2.0-only", GNU.format("program", ";", "", "", "2").replace("License as published", "License version 2 as published")
     .replace("Foundation either version 2 of the License, or\n    (at your option) any later version.", "Foundation.")),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 "
     "which is available at\nhttps://www.eclipse.org/legal/epl-2.0/\n\nMore."),
    ("MIT", "// SPDX-License-Identifier: MIT\nint main() {}"), ("GPL-2.0-or-later", "/* SPDX-License-Identifier: GPL-2.0-or-later */"),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty.\n\nPermission is granted to anyone to use this "
     "software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following "
     "restrictions:\n\n1. The origin must not be misrepresented."),
    ("CC-BY-NC-SA-4.0", CC.format("-NonCommercial-ShareAlike")),
]


def test_unshortened_notices(spark):
    restricted = [name for name, _ in FULL].index("CC-BY-NC-SA-4.0")
    commented = [(n, "".join(f" * {line.strip()}\n" for line in t.splitlines())) for n, t in FULL[:6]]
    got = scanned(spark, *[t for _, t in FULL + commented])
    assert [r["licenses"] for r in got] == [n for n, _ in FULL + commented]
    assert [k for k, r in enumerate(got) if r["restricted"]] == [restricted]


def test_rights_reserved_restricts_only_alone(spark):
    far = " ".join(f"Sentence number {k} says nothing." for k in range(30))
    got = scanned(spark, "Prose.\nAll rights reserved.", "All rights reserved.\nReleased under the MIT License.",
                  "Released under the MIT License. " + far + " All rights reserved.", "All rights reserved. All rights reserved.",
                  "All rights reserved. All rights reserved. Released under the MIT License.",
                  "All rights reserved. This program is free software.")
    assert [r["licenses"] for r in got] == ["Proprietary", "MIT", "MIT,Proprietary", "Proprietary", "MIT", "Proprietary"]
    assert [r["restricted"] for r in got] == [True, False, True, True, False, True]
