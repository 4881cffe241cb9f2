"""License scans: matching statistics against a suffix automaton of licence templates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .automaton import SuffixAutomaton
from .common import alnum_words, binary

#: Fixed phrases of the contract and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Shortest match that may take part in a chain, and the words a chain may skip between matches.
MIN_MATCH = 5
MAX_GAP = 8
#: Share of a template's words that its chained matches must cover for its label.
COVERAGE = 0.6

#: Publicly known licence texts or their notices, in natural order: (label, text).
_PERMISSION = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_NO_WARRANTY = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSEMENT = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_GPL_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. If not, see https://www.gnu.org/licenses/."
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", f"MIT License {_PERMISSION} {_NO_WARRANTY}"),
    ("mit", _PERMISSION),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache", "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", _GPL_NOTICE.format(name="General Public License")),
    ("gpl", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program, to make sure it remains free software for all its users."),
    ("lgpl", _GPL_NOTICE.format(name="Lesser General Public License")),
    ("agpl", _GPL_NOTICE.format(name="Affero General Public License")),
    ("bsd", f"{_REDISTRIBUTION} {_DISCLAIMER}"),
    ("bsd", f"{_REDISTRIBUTION} {_ENDORSEMENT} {_DISCLAIMER}"),
    ("bsd", _REDISTRIBUTION),
    ("isc", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_ISC_WARRANTY}"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("bsl", "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("cc0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
)


class Templates:
    """The automaton, and each template's words by automaton state for locating matches."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, min_match: int = MIN_MATCH):
        words = [alnum_words(t.encode()) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(w) for w in words]
        texts = [(("p", label), alnum_words(p.encode())) for p, label in phrases]
        self.phrase_labels = [label for _, label in phrases]
        longest = max(len(w) for _, w in texts)
        #: share that a phrase is of its label's shortest template
        self.phrase_share = {}
        for (_, label), w in texts:
            least = min([len(x) for x, (name, _) in zip(words, templates) if name == label] or [len(w)])
            self.phrase_share[label] = max(self.phrase_share.get(label, 0.0), min(1.0, len(w) / least))
        # texts of up to ``longest`` words report whole, so the window is one more
        self.auto = SuffixAutomaton.build(texts + [(i, w) for i, w in enumerate(words)], longest + 1, min_match)
        #: state -> (template, end) of every occurrence of its longest string
        self.ends: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(words):
            s = 0
            for end, x in enumerate(w, 1):
                s = self.auto.step(s, self.auto.vocab[x])
                at = s
                while at > 0:
                    self.ends.setdefault(at, []).append((i, end))
                    at = self.auto.link[at]

    def common(self, s: int, n: int) -> dict[tuple[int, int], int]:
        """(template, end) -> length of the longest suffix of the match (state, length) that ends there, if long enough."""
        out: dict[tuple[int, int], int] = {}
        while s > 0 and n >= self.auto.min_match:
            for place in self.ends.get(s, ()):
                out.setdefault(place, n)
            s = self.auto.link[s]
            n = self.auto.length[s]
        return out

    def scan(self, words: list[bytes]) -> dict:
        """Places of the phrases, and the chained matches: every common run with a template that goes no further on either side."""
        auto, places, found = self.auto, [], []
        ids = auto.encode(words)
        for a, b in auto.stretches(ids):
            running: dict[tuple[int, int], int] = {}
            for i, (s, n) in enumerate(auto.stream(ids[a:b].tolist()), a + 1):
                for size, (_, label) in auto.shorts(s, n):
                    places.append((i - size, label))
                if running or n >= auto.min_match:
                    now = self.common(s, n)
                    found += [(i - 1, t, end, length) for (t, end), length in running.items() if (t, end + 1) not in now]
                    running = now
            found += [(b, t, end, length) for (t, end), length in running.items()]
        return {"places": places, **self.chain(found)}

    def chain(self, found: list[tuple[int, int, int, int]]) -> dict:
        """Chain maximal matches (document end, template, its end, length), in order of their ends, into covered spans.

        A match goes on with the best chain of its template that ends at most MAX_GAP words before it in
        both texts, or overlaps it by as much in both; of those that cover as much the earliest. A later
        match may be longer and start earlier, but is no longer than its template: chains that end before
        that reach are let go, so the work grows with the matches near.
        """
        best: dict[str, float] = {}
        spans: dict[tuple[str, int], int] = {}
        open_: dict[int, list[tuple[int, int, int, int]]] = {}  # template -> (document end, template end, covered, first word)
        for end, t, at, n in found:
            held = [c for c in open_.get(t, ()) if c[0] >= end - self.sizes[t] - MAX_GAP]
            chained = (end, at, n, end - n)
            for d, x, covered, first in held:
                if d < end - n - MAX_GAP:
                    continue
                gap, skip = end - n - d, at - n - x
                if 0 <= gap <= MAX_GAP and 0 <= skip <= MAX_GAP:
                    more = n
                elif gap < 0 and end - d == at - x > 0:
                    more = end - d
                else:
                    continue
                if (covered + more, -first) > (chained[2], -chained[3]):
                    chained = (end, at, covered + more, first)
            held.append(chained)
            open_[t] = held
            share, label = chained[2] / self.sizes[t], self.labels[t]
            best[label] = max(best.get(label, 0.0), min(1.0, share))
            if share >= COVERAGE:
                key = (label, chained[3])
                spans[key] = max(spans.get(key, 0), end)
        return {"best": best, "spans": [(label, a, b) for (label, a), b in spans.items()]}


def _scan(shared, text_col: str):
    def run(batches):
        import pyarrow as pa

        model: Templates = shared.value
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for text in binary(batch, text_col):
                words = alnum_words(text)
                got = model.scan(words)
                starts = [p for p, _ in got["places"]]
                base = {label for _, label in got["places"]}
                own = {label for label, share in got["best"].items() if share >= COVERAGE}
                widest: dict[tuple[str, int], int] = {}
                for label, a, b in got["spans"]:
                    widest[label, a] = max(b, widest.get((label, a), 0))
                score = max([*got["best"].values(), *(model.phrase_share[x] for x in base)], default=0.0)
                row = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), round(score, 6), [f"{k}:{a}:{b}" for (k, a), b in sorted(widest.items(), key=lambda x: (x[0][1], x[0][0]))])
                for c, v in zip(cols, row):
                    cols[c].append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, type=k) for v, k in zip(cols.values(), kinds))], ["doc_id", *cols])

    return run


def scan(docs: DataFrame, *, text: str = "text", model: Templates | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``labels`` adds to the phrases' labels those of templates whose chained matches cover COVERAGE of
    their words; ``score`` is the best covered share of a template (a phrase alone is its share of its
    label's shortest); ``spans`` are ``label:first:end`` in words, of spans that start together the
    longest. Null or empty text has no words, labels or spans (score 0); repeated rows repeat; a very long
    text is streamed whole; an empty table gives an empty result; further columns are ignored. Narrow, no
    shuffle; the broadcast model has the size of the fixed templates.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or Templates())
    return docs.select("doc_id", text).mapInArrow(
        _scan(shared, text), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: The base columns alone.
BASE_SQL = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
p AS (SELECT r, unnest(list_filter(range(1, len(ws)), lambda i: (ws[i] = 'mit' OR ws[i] = 'apache') AND ws[i + 1] = 'license')) AS i, 1 AS k FROM w
  UNION ALL SELECT r, unnest(list_filter(range(1, len(ws) - 1), lambda i: ws[i] = 'general' AND ws[i + 1] = 'public' AND ws[i + 2] = 'license')), 2 FROM w),
l AS (SELECT p.r, i - 1 AS place, CASE WHEN k = 2 THEN 'gpl' ELSE ws[i] END AS label FROM p JOIN w ON w.r = p.r),
g AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM l GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(labels, '') AS base_labels FROM w LEFT JOIN g ON g.r = w.r
"""
