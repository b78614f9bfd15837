"""Every alternative that a license rule is written to find is found."""

import re._parser as parser
from itertools import product

from assay.llm import licenses


def _written(parts):
    """All texts that a parsed pattern of a rule matches; of a class, the first and the last member."""
    each = []
    for op, value in parts:
        match str(op):
            case "LITERAL":
                each.append([chr(value)])
            case "IN":
                each.append([chr(x) for o, v in value for x in ((v,) if str(o) == "LITERAL" else v)])
            case "BRANCH":
                each.append([t for branch in value[1] for t in _written(branch)])
            case "SUBPATTERN":
                each.append(_written(value[3]))
            case "ANY":
                each.append(["x"])
            case "MAX_REPEAT" | "MIN_REPEAT":
                low, high, part = value
                each.append(["".join(x) for n in {low, high} for x in product(_written(part), repeat=n)])
            case other:
                raise ValueError(other)
    return ["".join(x) for x in product(*each)]


def test_gates_let_all_alternatives_pass():
    for rule in licenses.rules():
        pattern = rule.pattern.pattern.decode().removeprefix(" (?=(").removesuffix(") )")
        written = _written(parser.parse(pattern))
        assert written
        for text in written:
            plain = f" {text} ".encode()
            assert rule.pattern.search(plain) and any(k in plain for k in rule.keywords), (rule.label, text)


def test_labels_without_the_first_keyword():
    rules = licenses.rules()
    judge = lambda t: licenses.judge(t.encode(), rules)["labels"]
    assert judge("under the GNU Library General Public License") == "gpl,lgpl"
    assert judge("the Expat license") == "mit" and judge("a Responsible AI License") == "openrail"
    assert judge("© 2020 someone") == "copyright"
    assert judge("Creative Commons Attribution-ShareAlike") == "cc-by-sa"
