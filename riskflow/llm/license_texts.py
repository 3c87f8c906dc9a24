"""Sentences by which public licenses are granted, as they stand in their texts or notices.

``body_windows`` adds whole license texts, from the files of ``license_bodies``.
"""

from __future__ import annotations

import re
from functools import cache
from importlib import resources

SHINGLE = 5
WINDOW_WORDS = 60
SHARED = 0.5  # a window that another license holds to this share names both
BODIES = {
    "Apache-2.0": "Apache-2.0",
    "GPL-2.0": "GPL-2",
    "GPL-3.0": "GPL-3",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3.0": "LGPL-3",
    "MPL-2.0": "MPL-2.0",
    "CC0-1.0": "CC0-1.0",
}

TEMPLATES = {
    ("Apache-2.0", "short"): "Licensed under the Apache License, Version 2.0.",
    ("Apache-2.0", "notice"): (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    ("Apache-2.0", "warranty"): (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    ("MIT", "short"): "Released under the MIT License.",
    ("MIT", "licensed"): "Licensed under the MIT License.",
    ("MIT", "grant"): (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    ("BSD", "grant"): (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    ("BSD-3-Clause", "names"): (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    ("ISC", "grant"): (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    ("GPL-3.0", "short"): "This work is licensed under the GNU General Public License, version 3.",
    ("GPL", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version"
    ),
    ("LGPL", "notice"): (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation"
    ),
    ("AGPL", "notice"): (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"
    ),
    ("MPL-2.0", "notice"): (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"
    ),
    ("EPL-2.0", "notice"): (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0"
    ),
    ("CC-BY-NC-4.0", "short"): "Licensed under CC BY-NC 4.0.",
    ("CC-BY-4.0", "notice"): "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ("CC-BY-SA-4.0", "notice"): (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    ("CC-BY-NC-4.0", "notice"): (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    ("CC0-1.0", "notice"): (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright "
        "and related or neighboring rights to this work."
    ),
    ("Unlicense", "grant"): "This is free and unencumbered software released into the public domain.",
    ("MIT", "disclaimer"): (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    ("BSD", "disclaimer"): (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    ("BSL-1.0", "grant"): (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following"
    ),
    ("Zlib", "grant"): (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions"
    ),
    ("CC-BY-4.0", "short"): "Licensed under CC BY 4.0.",
    ("CC-BY-SA-4.0", "short"): "Licensed under CC BY-SA 4.0.",
    ("CC-BY-ND-4.0", "short"): "Licensed under CC BY-ND 4.0.",
    ("CC-BY-NC-SA-4.0", "short"): "Licensed under CC BY-NC-SA 4.0.",
    ("CC-BY-NC-ND-4.0", "short"): "Licensed under CC BY-NC-ND 4.0.",
}

# Those that differ from one above by their version alone, so that only the version words tell them apart.
OTHER_VERSIONS = {
    ("GPL-2.0", "short"): "This work is licensed under the GNU General Public License, version 2.",
}


@cache
def body_windows() -> dict[tuple[str, str], str]:
    """Whole licenses in windows of ``WINDOW_WORDS`` words by (license, place of the first word).

    A window that other licenses hold too is listed once, under all their names.
    """
    folder = resources.files("riskflow.llm") / "license_bodies"
    words = {
        name: re.findall("[a-z0-9]+", (folder / f"{file}.txt").read_text("utf-8").lower()) for name, file in BODIES.items()
    }
    shingles = {name: set(zip(*(w[i:] for i in range(SHINGLE)))) for name, w in words.items()}
    found, listed = {}, set()
    for name, own in words.items():
        last = max(0, len(own) - WINDOW_WORDS)
        for at in sorted({*range(0, last + 1, WINDOW_WORDS), last}):
            part = own[at : at + WINDOW_WORDS]
            wanted = set(zip(*(part[i:] for i in range(SHINGLE))))
            holders = [n for n in words if n == name or len(wanted & shingles[n]) >= SHARED * len(wanted)]
            if len(wanted & listed) < SHARED * len(wanted):
                found[" or ".join(holders), f"{name} from word {at}"] = " ".join(part)
        listed |= shingles[name]
    return found
