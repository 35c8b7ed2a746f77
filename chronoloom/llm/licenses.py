"""Licence notices by the Dice coefficient of word bigrams.

A unit is a window of words, whatever lines they stand on. A template can reach the threshold t
only with windows whose number of bigrams is within [t / (2 - t), (2 - t) / t] times its own. A
window that starts or ends with a bigram foreign to the template gets better without it, so only
those from one of its bigrams to another are compared, and only where enough of them are near.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
THRESHOLD = 0.9

# Public notices and licence texts.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "reserved": "All rights reserved.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-2.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "LGPL-2.1 header": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "LGPL-3.0 header": """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


class Templates:
    def __init__(self, texts: dict[str, str], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be in (0, 1]")
        self.threshold = threshold
        self.items = []
        self.by_bigram: dict[tuple[str, str], list[int]] = {}
        for name, text in sorted(texts.items()):
            grams = Counter(bigrams(_WORD.findall(text.lower())))
            n = sum(grams.values())
            low, high = threshold / (2 - threshold) * n, (2 - threshold) / threshold * n
            for g in grams:
                self.by_bigram.setdefault(g, []).append(len(self.items))
            self.items.append((name, grams, n, low - 1e-9, high + 1e-9))

    def _windows(self, item: tuple, at: list[int], words: list[str]) -> list[tuple[float, int, int, int]]:
        """(Dice, shared bigrams, first, last bigram) over the threshold, none overlapping, best first."""
        _, grams, n, low, high = item
        need = self.threshold * (n + low) / 2
        found = []
        for i, a in enumerate(at):
            end = bisect_right(at, a + high - 1, i)
            if end - i < need - 1e-9:
                continue
            seen: Counter = Counter()
            same = 0
            for b in at[i:end]:
                g = (words[b], words[b + 1])
                seen[g] += 1
                same += seen[g] <= grams[g]
                size = b - a + 1
                if size >= low and 2 * same / (size + n) >= self.threshold:
                    found.append((-2 * same / (size + n), -size, a, b, same))
        kept: list[tuple[float, int, int, int]] = []
        taken = bytearray(len(words))  # words
        for dice, _, a, b, same in sorted(found):
            if not any(taken[a : b + 2]):
                taken[a : b + 2] = b"\1" * (b + 2 - a)
                kept.append((-dice, same, a, b))
        return kept

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, Dice, first line, last line) in order of place."""
        lines = [_WORD.findall(x) for x in (text or "").lower().split("\n")]
        words = [w for x in lines for w in x]
        near: dict[int, list[int]] = {}
        for i, g in enumerate(zip(words, words[1:])):
            for t in self.by_bigram.get(g, ()):
                near.setdefault(t, []).append(i)
        if not near:
            return []
        found = [
            (-same, -dice, self.items[t][0], a, b)
            for t, at in near.items()
            for dice, same, a, b in self._windows(self.items[t], at, words)
        ]
        line = [i for i, x in enumerate(lines) for _ in x]
        taken = bytearray(len(words))
        kept = []
        for _, dice, name, a, b in sorted(found):
            if not any(taken[a : b + 2]):
                taken[a : b + 2] = b"\1" * (b + 2 - a)
                kept.append((a, (name, -dice, line[a], line[b + 1])))
        return [m for _, m in sorted(kept)]


_MATCHES = pa.list_(
    pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())])
)


def _scan(texts: dict[str, str], threshold: float):
    def fn(batches):
        templates = Templates(texts, threshold)
        names = [f.name for f in _MATCHES.value_type]
        for batch in batches:
            found = [[dict(zip(names, m)) for m in templates.scan(t)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, _MATCHES)], names=["row", "licenses"])

    return fn


def scan(
    docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents with `licenses`: matched templates with Dice coefficient and line range.

    Of a template's overlapping windows the one with the highest coefficient counts, then the
    longer one; of those of several templates the one with most shared bigrams, then with the
    highest coefficient, then the first by name. Null and empty texts match nothing; templates with fewer than two
    words match nothing. A column called `licenses` is replaced, others stay.
    """
    cols = [c for c in docs.columns if c != "licenses"]
    packed = docs.select(F.col(text_col).alias("text"), F.struct(*cols).alias("row"))
    kind = "array<struct<license: string, dice: double, first_line: int, last_line: int>>"
    schema = f"row {packed.schema['row'].dataType.simpleString()}, licenses {kind}"
    return packed.mapInArrow(_scan(templates or TEMPLATES, threshold), schema).select("row.*", "licenses")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        F.col(id_col).alias("doc_id"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda m: m["license"]), ",").alias("licenses"),
        F.round(F.array_max(F.transform("licenses", lambda m: m["dice"])), 6).alias("best_dice"),
    )
