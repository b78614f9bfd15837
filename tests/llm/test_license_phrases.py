"""License signatures on phrases as people write them, and base phrases against a plain version."""

import random

from assay.llm import licenses
from tests.llm import brute, data

#: label expected among a phrase's labels: phrases.
PHRASES = {
    "mit": "License: MIT|MIT License|released under the MIT license|MIT-licensed code|This project is licensed under the MIT License|licensed under MIT|the Expat license|license = \"MIT\"|distributed under the terms of the MIT licence|"
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files|SPDX-License-Identifier: MIT",
    "apache-2.0": "Apache License 2.0|Apache-2.0|Apache License, Version 2.0|licensed under the Apache License, Version 2.0|Apache 2.0 licensed|Apache Software License 2.0|Apache License v2.0|License: Apache 2|ASL 2.0|released under Apache 2.0 license|"
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0|SPDX-License-Identifier: Apache-2.0|Apache2 license",
    "apache": "the Apache license|Apache Software License",
    "bsd-3-clause": "BSD-3-Clause|3-clause BSD license|New BSD License|Modified BSD|revised BSD license|BSD 3-Clause License|three-clause BSD",
    "bsd-2-clause": "BSD-2-Clause|2-clause BSD license|Simplified BSD License|FreeBSD license",
    "bsd": "BSD license|BSD-style license|Redistribution and use in source and binary forms, with or without modification, are permitted|under the BSD|License :: BSD|BSD licensed",
    "bsd-4-clause": "4-clause BSD license|original BSD license|SPDX-License-Identifier: BSD-4-Clause",
    "0bsd": "Zero-Clause BSD|0BSD license|BSD Zero Clause License",
    "gpl-3.0": "GPLv3|GPL v3|GPL-3.0|GPL 3|GNU GPLv3|GNU General Public License v3.0|GNU General Public License, version 3|GPL version 3|GPL-3.0-only|General Public License version 3|license: GPL-3.0",
    "gpl-3.0-or-later": "GPL-3.0-or-later|GPLv3 or later|GPL version 3 or any later version|either version 3: GNU General Public License version 3 or later",
    "gpl-2.0": "GPLv2|GPL v2|GPL-2.0|GNU GPL version 2|GNU General Public License v2.0|GPL 2.0 only|SPDX-License-Identifier: GPL-2.0",
    "gpl-2.0-or-later": "GPL-2.0-or-later|GPLv2 or later|GNU General Public License version 2 or later|SPDX-License-Identifier: GPL-2.0-or-later",
    "gpl": "GNU GPL|GPL license|under the GPL|GPL-licensed|the GNU General Public License|licensed under the GNU GPL",
    "lgpl-2.1": "LGPL v2.1|LGPL-2.1|LGPLv2.1|GNU Lesser General Public License v2.1|LGPL 2.1 or later|GNU LGPL 2.1|Lesser General Public License, version 2.1",
    "lgpl-3.0": "LGPL v3|LGPLv3|LGPL-3.0|GNU Lesser General Public License version 3|LGPL 3.0",
    "lgpl": "LGPL license|GNU LGPL license|Lesser General Public License|GNU Library General Public License|under the LGPL",
    "agpl-3.0": "AGPLv3|AGPL-3.0|AGPL v3|GNU Affero General Public License v3|GNU AGPLv3|Affero General Public License version 3.0|AGPL 3.0 or later",
    "agpl": "GNU Affero General Public License|AGPL license|AGPL-licensed",
    "mpl-2.0": "MPL 2.0|MPL-2.0|Mozilla Public License 2.0|Mozilla Public License, v. 2.0|MPLv2|Mozilla Public License Version 2.0",
    "mpl-1.1": "MPL 1.1|Mozilla Public License 1.1", "mpl": "Mozilla Public License|MPL license",
    "epl-2.0": "EPL 2.0|EPL-2.0|Eclipse Public License 2.0|Eclipse Public License v2.0", "epl-1.0": "EPL-1.0|Eclipse Public License - v 1.0", "epl": "the Eclipse Public License",
    "cc-by-4.0": "CC BY 4.0|CC-BY-4.0|Creative Commons Attribution 4.0 International License|Creative Commons Attribution 4.0|https://creativecommons.org/licenses/by/4.0/|Attribution 4.0 International|CC BY v4",
    "cc-by-3.0": "CC BY 3.0|Creative Commons Attribution 3.0 Unported", "cc-by-2.0": "CC BY 2.0|CC BY 2.5|Creative Commons Attribution 2.0 Generic",
    "cc-by-sa-4.0": "CC BY-SA 4.0|Creative Commons Attribution-ShareAlike 4.0 International|http://creativecommons.org/licenses/by-sa/4.0|CC-BY-SA-4.0",
    "cc-by-sa-3.0": "CC BY-SA 3.0|Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa": "CC BY-SA|Creative Commons Attribution Share Alike",
    "cc-by-nc-4.0": "CC BY-NC 4.0|Creative Commons Attribution-NonCommercial 4.0|creativecommons.org/licenses/by-nc/4.0", "cc-by-nc": "CC BY-NC|Creative Commons Attribution Non-Commercial license",
    "cc-by-nd-4.0": "CC BY-ND 4.0|Creative Commons Attribution-NoDerivatives 4.0 International", "cc-by-nd": "CC BY-ND|Creative Commons Attribution-NoDerivs",
    "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0|Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-nd-4.0": "CC BY-NC-ND 4.0|Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International",
    "cc0-1.0": "CC0 1.0|CC0|CC0 1.0 Universal Public Domain Dedication|CC0 license|publicdomain: creativecommons.org/publicdomain/zero/1.0/",
    "isc": "ISC License|license: ISC|Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "zlib": "zlib License|zlib/libpng license|SPDX-License-Identifier: Zlib", "boost-1.0": "Boost Software License 1.0|Boost Software License, Version 1.0|BSL-1.0",
    "unlicense": "The Unlicense|This is free and unencumbered software released into the public domain.", "wtfpl": "WTFPL|WTFPL v2|Do What The Fuck You Want To Public License",
    "public-domain": "dedicated to the public domain|This work is in the public domain|released into the public domain", "eupl-1.2": "EUPL-1.2|European Union Public Licence v1.2|EUPL v1.2",
    "cddl-1.0": "CDDL-1.0|Common Development and Distribution License 1.0", "artistic-2.0": "Artistic License 2.0|SPDX-License-Identifier: Artistic-2.0",
    "psf-2.0": "Python Software Foundation License|PSF License 2.0", "ofl-1.1": "SIL Open Font License 1.1|Open Font License|OFL 1.1", "ms-pl": "Microsoft Public License|MS-PL",
    "odbl-1.0": "Open Database License|ODbL 1.0|Open Data Commons Open Database License", "openrail": "OpenRAIL-M license|CreativeML OpenRAIL-M", "sspl-1.0": "Server Side Public License|SSPL v1",
    "bsl-1.1": "Business Source License 1.1", "gfdl": "GNU Free Documentation License 1.3|GFDL", "proprietary": "proprietary license|Proprietary and confidential|Unauthorized copying of this file, via any medium is strictly prohibited",
    "copyright": "Copyright 2021 Someone|Copyright (c) 2019|© 2020 A. Person", "reserved": "All Rights Reserved.|Some rights reserved", "llama": "Llama 2 Community License", "ncsa": "NCSA Open Source License",
}
#: Phrases that name no license.
NEAR_MISSES = (
    "limit of mitten|the committee submitted it|MIT was founded in 1861|an apache helicopter|the Apache people|Boost your software|a common public place|in general, public licenses differ|"
    "she has a driving license|the license plate|licensed to drive|zlib compresses data|python is a snake|mozilla builds browsers|the eclipse was public|vim is an editor|a public domain name is|GPS v3|EPLF 2|"
    "creative and common sense|attribution matters|the curl of a vector|artistic freedom|an elastic band|a gemma stone|academic freedom"
).split("|")


def _labels(text, rules):
    return set(licenses.judge(text.encode(), rules)["labels"].split(",")) - {""}


def test_phrases():
    rules = licenses.rules()
    cases = [(label, p) for label, phrases in PHRASES.items() for p in phrases.split("|")]
    missed = [c for c in cases if c[0] not in _labels(f"Some words before. {c[1]}; and more after.", rules)]
    assert len(cases) > 150 and len(missed) <= 0.02 * len(cases), missed
    wrong = [p for p in NEAR_MISSES if _labels(p, rules)]
    assert len(wrong) <= 1, wrong
    assert len({r.pattern for r in rules}) > 200


def _base(text):
    words = brute.PLAIN.findall(brute.lower(text))
    places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_phrases(spark):
    r = random.Random(11)
    parts = "CC-BY|cc by|General Public License|general public|all rights reserved|All Rights\nReserved|rights|cc|by|é|word|, ".split("|")
    rows = [(i, " ".join(r.choice(parts) for _ in range(r.randrange(0, 40))), "x") for i in range(200)] + [(None, None, None), (3, "", "y"), (4, "cc by " * 5000, "y"), (4, "cc by " * 5000, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, labels string")
    data.same(licenses.scan(docs), ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"], [(d, *_base(t)) for d, t, _ in rows])


def test_many_hits_take_linear_time():
    import time

    rules, took = licenses.rules(), []
    for n in (2_000, 16_000):
        began = time.process_time()
        licenses.judge(b"MIT license, GPLv3. " * n, rules)
        took.append(time.process_time() - began)
    assert took[1] < 24 * max(took[0], 0.05)
