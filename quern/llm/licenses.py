"""License scans by conditional compression.

Candidate blocks are the sentences of a text that hold a license cue, within a line and over the lines of a paragraph, and the paragraphs
that hold one. Each is compressed alone and with every template as a zstandard raw dictionary. The templates that shrink it enough are
confirmed by their exact wording differences: the words of template and block are aligned, and what differs is counted. Of blocks that
overlap, the one that differs least counts.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import once, table

MIN_REDUCTION = 0.25  # of the bytes of the block compressed alone
MAX_DIFFERENT = 0.20  # of the template's words, missing or replaced

CUE = re.compile(r"licen[cs]|copyright|spdx|creative[\W_]+commons|cc[\W_]+by|public[\W_]+domain|warranty|redistribut|permission[\W_]+is[\W_]+(?:hereby|granted)|permission[\W_]+to[\W_]+use|all[\W_]+rights[\W_]+reserved", re.I)
SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=\s|\Z|[^\w\s])|(?=\n)|\Z)[^\w\s]*", re.S)
WRAPPED = re.compile(r".*?(?:[.!?](?=\s|\Z|[^\w\s])|\Z)[^\w\s]*", re.S)  # a sentence over lines
WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")

#: Wordings of public licenses, notices as they stand in source files and documents.
TEMPLATES = {
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "Artistic-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",),
    "BSD-2-Clause": ("Licensed under the Simplified BSD License.", "This work is licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-SA-3.0": ("Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"),
    "CDDL-1.0": ("The contents of this file are subject to the terms of the Common Development and Distribution License (the License).",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "SPDX-License-Identifier: EPL-2.0"),
    "EUPL-1.2": ("Licensed under the European Union Public Licence, version 1.2 (the Licence).",),
    "GFDL-1.3": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.",),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This file is licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "OFL-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1.",),
    "PSF-2.0": ("Licensed to the Python Software Foundation under a Contributor Agreement, and distributed under the Python Software Foundation License Version 2.",),
    "Proprietary": ("All rights reserved.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "WTFPL": ("This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2.",),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
}


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(re.sub(r"-\n[^\w\n]*", "-", text))]


class Scanner:
    """Compressors, one for each wording."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        import zstandard as zs

        self.wordings = [(name, words(text)) for name, texts in sorted(templates.items()) for text in texts]
        options = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        self.plain = zs.ZstdCompressor(level=3, **options)
        self.primed = [zs.ZstdCompressor(level=3, dict_data=zs.ZstdCompressionDict(" ".join(w).encode(), dict_type=zs.DICT_TYPE_RAWCONTENT), **options) for _, w in self.wordings]

    def best(self, block: str) -> tuple[str, float, int, int] | None:
        """(license, reduction, words missing or replaced, words added) of the best confirmed wording."""
        got = words(block)
        raw = " ".join(got).encode()
        if not raw:
            return None
        alone = len(self.plain.compress(raw))
        found = []
        for (name, wanted), compressor in zip(self.wordings, self.primed, strict=True):
            reduction = 1 - len(compressor.compress(raw)) / alone
            if reduction < MIN_REDUCTION:
                continue
            same = sum(m.size for m in difflib.SequenceMatcher(None, wanted, got, autojunk=False).get_matching_blocks())
            missing = len(wanted) - same
            if missing <= MAX_DIFFERENT * len(wanted):
                found.append((missing + len(got) - same, -reduction, name, reduction, missing, len(got) - same))
        if not found:
            return None
        _, _, name, reduction, missing, added = min(found)
        return name, reduction, missing, added


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Candidate (start, end) spans of the text."""
    if not CUE.search(text):
        return
    at = 0
    for paragraph in re.split(r"(\n\s*\n)", text):
        end = at + len(paragraph)
        if CUE.search(paragraph):
            held = [(at + m.start(), at + m.end()) for m in SENTENCE.finditer(paragraph) if m.end() > m.start() and CUE.search(m[0])]
            over = [(at + m.start(), at + m.end()) for m in WRAPPED.finditer(paragraph) if m.end() > m.start() and CUE.search(m[0])] if "\n" in paragraph else []
            more = [(held[0][0], held[-1][1])] if len(held) > 1 else []
            lead = len(paragraph) - len(paragraph.lstrip())
            yield from dict.fromkeys([*held, *over, *more, (at + lead, at + len(paragraph.rstrip()))])
        at = end


def scan(text: str | None, scanner: Scanner) -> list[tuple[str, int, int, float, int, int]]:
    """(license, start, end, reduction, missing, added) of each confirmed block; of those that overlap, the least different, then the shortest."""
    found = [(best[0], start, end, *best[1:]) for start, end in blocks(text or "") if (best := scanner.best(text[start:end]))]
    out: list[tuple[str, int, int, float, int, int]] = []
    for x in sorted(found, key=lambda x: (x[4] + x[5], x[2] - x[1], x[1])):
        if not any(x[1] < end and start < x[2] for _, start, end, *_ in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1])


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed block: doc_id, license, start, end (code points), reduction, n_missing, n_added.

    Texts that are null, blank or without a cue have no rows. Null ids and repeated documents keep their rows; of equally near wordings the one that
    reduces more, then the first by name, counts. Other columns are ignored; an empty table gives an empty result. Whole texts are scanned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(templates if templates is not None else TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = once(shared.value, Scanner)
        kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out += [(doc, name, s, e, round(r, 6), m, a) for name, s, e, r, m, a in scan(text.as_py(), scanner)]
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "license", "start", "end", "reduction", "n_missing", "n_added"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, license string, start long, `end` long, reduction double, n_missing long, n_added long")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
