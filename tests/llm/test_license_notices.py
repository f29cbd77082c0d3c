from scorewright.llm.licenses import scan_licenses

MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def commented(text, mark, first="", last=""):
    return first + "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines()) + last


CASES = [
    ("MIT", MIT), ("BSD", BSD), ("BSD-3-Clause", BSD3), ("Apache-2.0", APACHE), ("GPL-2.0-or-later", GPL % (";", ";", 2)),
    ("GPL-3.0-or-later", GPL % (":", ",", 3)), ("MPL-2.0", MPL),
    ("MIT", "Released under the MIT License, see the file LICENSE."), ("MIT", "This project is licensed under the\nMIT license."),
    ("LGPL", "This library is old. Released under the GNU Lesser General Public\nLicense (version 2.1)."),
    ("CC0-1.0", "Some words.\nPlaced in the public\ndomain."), (None, "This is no MIT license, nor is it in the public domain."),
]


def test_wrapped_notices(spark):
    rows = [(k, t) for k, (_, t) in enumerate(CASES)]
    rows += [(100 + k, commented(t, " *", "/*\n", " */\n")) for k, t in rows] + [(200 + k, commented(t, "#")) for k, t in rows]
    got = {r.doc_id: r.license for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {n + k: name for k, (name, _) in enumerate(CASES) for n in (0, 100, 200)}
