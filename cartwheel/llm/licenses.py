"""Licence scans by rules over known sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import texts

# Wording of licence notices, and the order in which their sentences stand.
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "you may not use this file except in compliance with the license",
    3: "you may obtain a copy of the license at",
    4: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    5: "see the license for the specific language governing permissions and limitations under the license",
    6: "licensed under the apache license version 2 0 the license",
    7: "released under the mit license",
    8: "licensed under the mit license",
    9: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    10: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    11: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    12: "this work is licensed under the gnu general public license version 3",
    13: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    14: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    15: "you should have received a copy of the gnu general public license along with this program",
    16: "licensed under cc by nc 4 0",
    17: "licensed under cc by 4 0",
    18: "licensed under cc by sa 4 0",
    19: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    20: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    21: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    22: "this source code form is subject to the terms of the mozilla public license v 2 0",
    23: "all rights reserved",
    24: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    25: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    26: "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    27: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    28: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    29: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    30: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    31: "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    32: "you should have received a copy of the gnu lesser general public license along with this library",
    33: "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    34: "you should have received a copy of the gnu lesser general public license along with this program",
    35: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    36: "you should have received a copy of the gnu affero general public license along with this program",
    37: "this software is provided as is without any express or implied warranty",
    38: "in no event will the authors be held liable for any damages arising from the use of this software",
    39: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    40: "this is free and unencumbered software released into the public domain",
    41: "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    42: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    43: "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
}
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
RULES = {
    "Apache-2.0-notice": (1,),
    "Apache-2.0-header": (6, 2, 3, 4, 5),
    "MIT-notice": (7,),
    "MIT-licensed": (8,),
    "MIT-text": (9, 10, 11),
    "GPL-3.0-notice": (12,),
    "GPL-3.0-or-later-header": (13, 14, 15),
    "CC-BY-NC-4.0-notice": (16,),
    "CC-BY-4.0-notice": (17,),
    "CC-BY-SA-4.0-notice": (18,),
    "BSD-2-Clause-text": (19, 20, 21),
    "MPL-2.0-notice": (22,),
    "BSD-3-Clause-text": (19, 20, 21, 24),
    "ISC-text": (25, 26),
    "0BSD-text": (27, 26),
    "GPL-2.0-or-later-header": (28, 14, 15),
    "GPL-2.0-only-header": (29,),
    "LGPL-2.1-or-later-header": (30, 31, 32),
    "LGPL-3.0-or-later-header": (33, 14, 34),
    "AGPL-3.0-or-later-header": (35, 14, 36),
    "Zlib-text": (37, 38, 39),
    "Unlicense-text": (40, 41),
    "EPL-2.0-header": (42,),
    "EPL-1.0-header": (43,),
}
# Older names, without "-only"; a plus behind one is read as "-or-later".
SPDX += tuple(name.removesuffix("-only") for name in SPDX if name.endswith("-only"))
SPDX_FIRST = 100
SENTENCES |= {n: "spdx license identifier " + name.lower().replace("-", " ").replace(".", " ") for n, name in enumerate(SPDX, SPDX_FIRST)}
RULES |= {f"{name}-spdx": (n,) for n, name in enumerate(SPDX, SPDX_FIRST)}
GAP = 2
#: The tag and its expression, which are a sentence of their own wherever they stand; "A OR B" is no known sentence.
SPDX_TAG = "SPDX-License-Identifier:"
SPDX_LINE = f"{SPDX_TAG}[ \\t]*([A-Za-z0-9.+-]+(?:[ \\t]+(?:OR|AND|WITH)[ \\t]+[A-Za-z0-9.+-]+)*)"
#: A sentence ends behind . ! ? : ; and blanks, or at a line end, unless the next line goes on with a small letter or a
#: bracket as wrapped lines do.
AFTER_STOP, LINE_END = "([.!?:;])[ \\t\\r\\n]+", "[\\r\\n]+([^a-z(\\r\\n])"
#: What is put into the text where it is cut: behind a stop, at a blank line that ends no sentence, at the end of one line.
CUT, BLANK, LINE = "\x01", "\x02", "\x03"
MARKS = CUT + BLANK + LINE
BLANK_LINES = "\\r?\\n(?:[ \\t]*\\r?\\n)+"


def swap(text: Column, mark: str, by: str) -> Column:
    return F.replace(text, F.lit(mark), F.lit(by))


def marked(text: Column) -> Column:
    """Letters a-z and digits in single blanks, and one mark where a sentence ends or might: LINE at a line end, BLANK at
    a blank line before a small letter, CUT at any other end; the text stands between two CUTs."""
    tags = F.regexp_replace(text, SPDX_LINE, f"{CUT}SPDX-License-Identifier $1{CUT}")
    tags = F.regexp_replace(tags, f"(SPDX-License-Identifier [A-Za-z0-9.-]+)[+]{CUT}", f"$1-or-later{CUT}")
    text = F.when(F.contains(text, F.lit(SPDX_TAG)), tags).otherwise(text)
    cut = F.regexp_replace(swap(swap(text, BLANK, " "), LINE, " "), AFTER_STOP, f"$1{CUT}")
    cut = F.regexp_replace(F.regexp_replace(cut, BLANK_LINES, f"{BLANK}$0"), LINE_END, f"{LINE}$1")
    plain = F.regexp_replace(F.lower(F.concat(F.lit(CUT), cut, F.lit(CUT))), f"[^a-z0-9{MARKS}]+", " ")
    close = F.regexp_replace(F.regexp_replace(plain, f" ?([{MARKS}]) ?", "$1"), f"{BLANK}+", BLANK)
    return F.regexp_replace(close, f"[{MARKS}]{{2,}}", CUT)


def named(line: Column, sentences: dict[int, str]) -> Column:
    """The marked text with =number between two CUTs for each known sentence, the longest wording first."""
    whole = {n: f"[{MARKS}]" + s.replace(" ", f"[ {MARKS}]") + f"(?=[{MARKS}])" for n, s in sentences.items()}
    # Few texts know a sentence; the others are looked through once.
    some = line.rlike(f"[{MARKS}](?:{'|'.join(w[len(MARKS) + 2 :] for w in whole.values())})")
    done = line
    for number in sorted(whole, key=lambda n: -len(sentences[n])):
        done = F.regexp_replace(done, whole[number], f"{CUT}={number}")
    done = F.regexp_replace(done, f"(=[0-9]+)[{BLANK}{LINE}]", f"$1{CUT}")
    return swap(F.when(some, done).otherwise(line), BLANK, " ")


def rules_pattern(rules: dict[str, tuple[int, ...]], gap: int) -> str:
    """One pattern for all rules over a line of identifiers, the longest rule first, so that a rule that continues
    another is preferred."""
    ordered = sorted(rules.values(), key=lambda steps: (-len(steps), steps))
    return "|".join(f"(?:-;){{0,{gap}}}".join(f"{n};" for n in steps) for steps in ordered)


def licenses(docs: DataFrame, sentences: dict[int, str] = SENTENCES, rules: dict[str, tuple[int, ...]] = RULES, gap: int = GAP) -> DataFrame:
    """doc_id, n_sentences, known (identifiers of its known sentences, in order) and licences (name:times, by name).

    A known sentence is all its words, from one sentence end, line end or blank line to another; line ends, comment marks
    and stops may stand between any of them, so that wording is found as it is usually wrapped ("free software: you",
    "v. 2.0"). It counts as one sentence; so does an SPDX tag with its expression. A rule holds where its identifiers
    stand in its order with at most ``gap`` other sentences between two of them, found from the left without overlaps,
    the longest rule first (three BSD clauses are no two clauses); there, wrapped lines count as one sentence. Null and empty texts have no sentences; repeated rows give repeated rows, an empty table none; other
    columns are ignored. All work is done per row inside the scan; nothing is shuffled.
    """
    row = texts(docs).select("doc_id", marked(F.col("text")).alias("line"))
    row = row.select("doc_id", named(F.col("line"), sentences).alias("line"))

    def ids(line: Column) -> Column:
        every = F.filter(F.split(line, CUT), lambda s: s != "")
        return F.transform(every, lambda s: F.when(s.startswith("="), F.substr(s, F.lit(2))).otherwise(F.lit("-")))

    row = row.select("doc_id", ids(swap(F.col("line"), LINE, CUT)).alias("ids"), ids(swap(F.col("line"), LINE, " ")).alias("wrapped"))
    known = F.filter("ids", lambda s: s != "-").alias("known")
    row = row.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), known, F.concat(F.array_join("wrapped", ";"), F.lit(";")).alias("line"))
    names = F.create_map(*[F.lit(x) for name, steps in rules.items() for x in ("".join(f"{n};" for n in steps), name)])
    found = F.regexp_extract_all("line", F.lit(f"(?<![0-9])(?:{rules_pattern(rules, gap)})"), F.lit(0))
    held = F.transform(found, lambda steps: F.element_at(names, swap(steps, "-;", "")))
    times = F.transform(
        F.array_sort(F.array_distinct(held)),
        lambda name: F.concat_ws(":", name, F.size(F.filter(held, lambda h: h == name)).cast("string")),
    )
    return row.select(
        "doc_id", "n_sentences", "known", F.when(F.size("known") > 0, times).otherwise(F.array().cast("array<string>")).alias("licences")
    )
