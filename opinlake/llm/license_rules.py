"""Ordered signature rules of license notices.

A line is `label | keyword | kind | pattern`. The keyword, in lower case, is in every text that the
pattern matches, so the rule runs only on texts that have it. A blank in a pattern stands for white
space, comment marks and line breaks, as many as there are. Kinds, from the best to the least: `tag` (a machine-readable
identifier), `text` (words of the license itself), `name` (its title), `url`, `hint` (a mention).
Of equal kinds, earlier lines come first. Patterns use what Java's and Python's `re` share.

Tags are looked for inside the lines that `EXPRESSION` finds: the first identifier, behind brackets or
not, and every one that AND or OR joins to it.
"""

from __future__ import annotations

from dataclasses import dataclass

KINDS = ("tag", "text", "name", "url", "hint")
CONFIDENCE = {"tag": 1.0, "text": 0.95, "name": 0.85, "url": 0.8, "hint": 0.5}
GAP = r"[\s*#/;>%!\"'-]++"
EXPRESSION = r"(?i)(?<![A-Za-z0-9])SPDX-License-Identifier:[^\r\n]*+"

# Identifiers for which a tag rule is made.
TAGGED = """
0bsd:0BSD afl-3.0:AFL-3\\.0 agpl-3.0:AGPL-3\\.0 apache-2.0:Apache-2\\.0 apache-1.1:Apache-1\\.1
artistic-1.0:Artistic-1\\.0 artistic-2.0:Artistic-2\\.0 blueoak-1.0.0:BlueOak-1\\.0\\.0
bsd-1-clause:BSD-1-Clause bsd-2-clause:BSD-2-Clause bsd-3-clause:BSD-3-Clause bsd-4-clause:BSD-4-Clause
bsl-1.0:BSL-1\\.0 busl-1.1:BUSL-1\\.1 cc-by-3.0:CC-BY-3\\.0 cc-by-4.0:CC-BY-4\\.0 cc-by-sa-3.0:CC-BY-SA-3\\.0
cc-by-sa-4.0:CC-BY-SA-4\\.0 cc-by-nc-4.0:CC-BY-NC-4\\.0 cc-by-nd-4.0:CC-BY-ND-4\\.0
cc-by-nc-sa-4.0:CC-BY-NC-SA-4\\.0 cc-by-nc-nd-4.0:CC-BY-NC-ND-4\\.0 cc0-1.0:CC0-1\\.0 cddl-1.0:CDDL-1\\.0
cddl-1.1:CDDL-1\\.1 cecill-2.1:CECILL-2\\.1 cpl-1.0:CPL-1\\.0 ecl-2.0:ECL-2\\.0 epl-1.0:EPL-1\\.0
epl-2.0:EPL-2\\.0 eupl-1.1:EUPL-1\\.1 eupl-1.2:EUPL-1\\.2 fdl-1.3:GFDL-1\\.3 ftl:FTL gpl-1.0:GPL-1\\.0
gpl-2.0:GPL-2\\.0 gpl-3.0:GPL-3\\.0 isc:ISC lgpl-2.0:LGPL-2\\.0 lgpl-2.1:LGPL-2\\.1 lgpl-3.0:LGPL-3\\.0
lppl-1.3c:LPPL-1\\.3c mit:MIT mit-0:MIT-0 mpl-1.1:MPL-1\\.1 mpl-2.0:MPL-2\\.0 ms-pl:MS-PL ms-rl:MS-RL
mulanpsl-2.0:MulanPSL-2\\.0 ncsa:NCSA odbl-1.0:ODbL-1\\.0 ofl-1.1:OFL-1\\.1 openssl:OpenSSL osl-3.0:OSL-3\\.0
php-3.01:PHP-3\\.01 postgresql:PostgreSQL psf-2.0:Python-2\\.0 ruby:Ruby sspl-1.0:SSPL-1\\.0
unicode-3.0:Unicode-3\\.0 unlicense:Unlicense upl-1.0:UPL-1\\.0 vim:Vim w3c:W3C wtfpl:WTFPL x11:X11
zlib:Zlib zpl-2.1:ZPL-2\\.1
""".split()

LINES = r"""
apache-2.0 | apache | text | licensed under the apache license,? version 2\.0
apache-2.0 | apache | name | apache (?:software )?licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?
apache-2.0 | apache | url | apache\.org/licenses/LICENSE-2\.0
apache-1.1 | apache | name | apache software licen[cs]e,?(?: version| v\.?)? 1\.1
apache-1.0 | apache | name | apache software licen[cs]e,?(?: version| v\.?)? 1\.0
apache-1.1 | apache | url | apache\.org/licenses/LICENSE-1\.1
apache-any | apache | hint | (?:under|with) (?:the )?apache licen[cs]e
mit | permission | text | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | released | text | released under the mit licen[cs]e
mit | licensed | text | licensed under the mit licen[cs]e
mit | mit | name | the mit licen[cs]e(?: \(mit\))?
mit | mit | name | mit licen[cs]e
mit | opensource | url | opensource\.org/licenses/mit(?:-license)?
mit | mit | hint | (?:under|licen[cs]e:?) mit
mit-0 | attribution | name | mit no attribution
x11 | x11 | name | x11 licen[cs]e
x11 | consortium | text | except as contained in this notice, the name of the x consortium
bsd-2-clause | bsd | name | (?:simplified|2-clause|two-clause|freebsd) bsd(?: licen[cs]e)?
bsd-2-clause | bsd | name | bsd 2-clause(?: licen[cs]e)?
bsd-2-clause | opensource | url | opensource\.org/licenses/bsd-2-clause
bsd-3-clause | bsd | name | (?:new|modified|revised|3-clause|three-clause) bsd(?: licen[cs]e)?
bsd-3-clause | bsd | name | bsd 3-clause(?: licen[cs]e)?
bsd-3-clause | endorse | text | neither the names? of .{1,80} nor the names of its contributors may be used to endorse
bsd-3-clause | opensource | url | opensource\.org/licenses/bsd-3-clause
bsd-4-clause | advertising | text | all advertising materials mentioning features or use of this software
bsd-4-clause | bsd | name | (?:original|4-clause|four-clause) bsd(?: licen[cs]e)?
bsd-any | redistribution | text | redistribution and use in source and binary forms, with or without modification
bsd-any | bsd | hint | bsd-style licen[cs]e
bsd-any | bsd | hint | bsd licen[cs]e
0bsd | bsd | name | (?:zero-clause|0-clause|free public) bsd(?: licen[cs]e)?
isc | isc | name | isc licen[cs]e
isc | permission | text | permission to use, copy, modify, and(?:/or)? distribute this software for any purpose
isc | opensource | url | opensource\.org/licenses/isc
gpl-1.0 | gpl | name | gpl ?v?1(?:\.0)?
gpl-2.0 | gpl | name | gpl ?v?2(?:\.0)?
gpl-3.0 | gpl | name | gpl ?v?3(?:\.0)?
gpl-2.0 | gnu | name | gnu general public licen[cs]e,?(?: as published by the free software foundation[;,])?(?: either)? version 2
gpl-3.0 | gnu | name | gnu general public licen[cs]e,?(?: as published by the free software foundation[;,])?(?: either)? version 3
gpl-any | general | name | gnu general public licen[cs]e
gpl-any | general | hint | general public licen[cs]e
gpl-any | gpl | hint | (?:under|with) (?:the )?(?:gnu )?gpl
gpl-any | redistribute | text | you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e
gpl-2.0 | gnu\.org | url | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3.0 | gnu\.org | url | gnu\.org/licenses/gpl-3\.0
gpl-any | gnu\.org | url | gnu\.org/licenses/gpl
lgpl-2.0 | library | name | gnu library general public licen[cs]e
lgpl-2.1 | lesser | name | gnu lesser general public licen[cs]e,?(?: either)? version 2\.1
lgpl-3.0 | lesser | name | gnu lesser general public licen[cs]e,?(?: either)? version 3
lgpl-any | lesser | name | (?:gnu )?lesser general public licen[cs]e
lgpl-2.1 | lgpl | name | lgpl ?v?2\.1
lgpl-3.0 | lgpl | name | lgpl ?v?3(?:\.0)?
lgpl-any | lgpl | hint | (?:under|with) (?:the )?(?:gnu )?lgpl
lgpl-2.1 | gnu\.org | url | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3.0 | gnu\.org | url | gnu\.org/licenses/lgpl-3\.0
agpl-3.0 | affero | name | gnu affero general public licen[cs]e(?:,? version 3)?
agpl-3.0 | agpl | name | agpl ?v?3(?:\.0)?
agpl-3.0 | gnu\.org | url | gnu\.org/licenses/agpl
agpl-any | affero | hint | affero general public licen[cs]e
fdl-1.3 | documentation | name | gnu free documentation licen[cs]e
fdl-any | gfdl | hint | (?:gnu )?gfdl
fdl-1.3 | gnu\.org | url | gnu\.org/licenses/fdl
mpl-1.1 | mozilla | name | mozilla public licen[cs]e,?(?: version| v\.?)? 1\.1
mpl-2.0 | mozilla | name | mozilla public licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?
mpl-2.0 | mozilla | text | subject to the terms of the mozilla public licen[cs]e, v\. 2\.0
mpl-2.0 | mozilla | url | mozilla\.org/MPL/2\.0
mpl-1.1 | mozilla | url | mozilla\.org/MPL/MPL-1\.1
mpl-any | mozilla | hint | mozilla public licen[cs]e
mpl-2.0 | mpl | name | mpl ?v?2(?:\.0)?
mpl-1.1 | mpl | name | mpl ?v?1\.1
epl-1.0 | eclipse | name | eclipse public licen[cs]e,?(?: -)?(?: version| v\.?)? ?1(?:\.0)?
epl-2.0 | eclipse | name | eclipse public licen[cs]e,?(?: -)?(?: version| v\.?)? ?2(?:\.0)?
epl-2.0 | eclipse | url | eclipse\.org/legal/epl-2\.0
epl-1.0 | eclipse | url | eclipse\.org/legal/epl-v10
epl-any | eclipse | hint | eclipse public licen[cs]e
edl-1.0 | eclipse | name | eclipse distribution licen[cs]e
cpl-1.0 | common | name | common public licen[cs]e(?: version)? 1\.0
cddl-1.0 | distribution | name | common development and distribution licen[cs]e(?: \(cddl\))?(?: version)?(?: 1\.0)?
cddl-any | cddl | hint | cddl
cddl-1.0 | opensource | url | opensource\.org/licenses/cddl1
eupl-1.2 | european | name | european union public licen[cs]e(?: v\.? ?1\.2)?
eupl-any | eupl | hint | eupl(?: v\.?)? ?1\.[012]
artistic-1.0 | artistic | name | (?:the )?artistic licen[cs]e 1\.0
artistic-2.0 | artistic | name | (?:the )?artistic licen[cs]e 2\.0
artistic-any | artistic | hint | artistic licen[cs]e
artistic-any | perl | text | under the same terms as perl(?: 5)?(?: programming language system)? itself
artistic-2.0 | opensource | url | opensource\.org/licenses/artistic-license-2\.0
bsl-1.0 | boost | name | boost software licen[cs]e(?:[ -,]{1,4}version 1\.0)?
bsl-1.0 | boost | url | boost\.org/LICENSE_1_0\.txt
busl-1.1 | business | name | business source licen[cs]e(?: 1\.1)?
cc0-1.0 | cc0 | name | cc0(?: 1\.0)?(?: universal)?
cc0-1.0 | dedication | text | creative commons(?: cc0)? public domain dedication
cc0-1.0 | creativecommons | url | creativecommons\.org/publicdomain/zero/1\.0
public-domain | creativecommons | url | creativecommons\.org/publicdomain/mark/1\.0
public-domain | domain | text | (?:released|placed|dedicated) (?:in)?to the public domain
public-domain | domain | hint | (?:is|are) in the public domain
unlicense | unencumbered | text | this is free and unencumbered software released into the public domain
unlicense | unlicense | name | the unlicense
unlicense | unlicense | url | unlicense\.org
cc-by-4.0 | creativecommons | url | creativecommons\.org/licenses/by/4\.0
cc-by-3.0 | creativecommons | url | creativecommons\.org/licenses/by/3\.0
cc-by-2.0 | creativecommons | url | creativecommons\.org/licenses/by/2\.0
cc-by-sa-4.0 | creativecommons | url | creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa-3.0 | creativecommons | url | creativecommons\.org/licenses/by-sa/3\.0
cc-by-nc-4.0 | creativecommons | url | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc-3.0 | creativecommons | url | creativecommons\.org/licenses/by-nc/3\.0
cc-by-nd-4.0 | creativecommons | url | creativecommons\.org/licenses/by-nd/4\.0
cc-by-nc-sa-4.0 | creativecommons | url | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-sa-3.0 | creativecommons | url | creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-nd-4.0 | creativecommons | url | creativecommons\.org/licenses/by-nc-nd/4\.0
cc-any | creativecommons | url | creativecommons\.org/licenses/[a-z-]{2,8}
cc-by-nc-sa-4.0 | noncommercial | name | attribution[ -]noncommercial[ -]sharealike 4\.0(?: international)?
cc-by-nc-nd-4.0 | noncommercial | name | attribution[ -]noncommercial[ -]noderiv(?:ative)?s 4\.0(?: international)?
cc-by-nc-4.0 | noncommercial | name | attribution[ -]noncommercial 4\.0(?: international)?
cc-by-sa-4.0 | sharealike | name | attribution[ -]sharealike 4\.0(?: international)?
cc-by-sa-3.0 | sharealike | name | attribution[ -]sharealike 3\.0(?: unported)?
cc-by-nd-4.0 | attribution | name | attribution[ -]noderiv(?:ative)?s 4\.0(?: international)?
cc-by-4.0 | attribution | name | (?:creative commons )?attribution 4\.0(?: international)?
cc-by-3.0 | attribution | name | (?:creative commons )?attribution 3\.0(?: unported)?
cc-by-nc-sa-4.0 | cc | name | cc[ -]by[ -]nc[ -]sa(?:[ -]4\.0)?
cc-by-nc-nd-4.0 | cc | name | cc[ -]by[ -]nc[ -]nd(?:[ -]4\.0)?
cc-by-sa-3.0 | cc | name | cc[ -]by[ -]sa[ -]3\.0
cc-by-sa-4.0 | cc | name | cc[ -]by[ -]sa(?:[ -]4\.0)?
cc-by-nc-4.0 | cc | name | cc[ -]by[ -]nc(?:[ -]4\.0)?
cc-by-nd-4.0 | cc | name | cc[ -]by[ -]nd(?:[ -]4\.0)?
cc-by-3.0 | cc | name | cc[ -]by[ -]3\.0
cc-by-4.0 | cc | name | cc[ -]by[ -]4\.0
cc-by-any | cc | hint | (?:under|licen[cs]e:?) cc[ -]by
cc-any | creative | hint | creative commons(?: licen[cs]e)?
zlib | zlib | name | zlib(?:/libpng)? licen[cs]e
zlib | altered | text | altered source versions must be plainly marked as such
libpng-2.0 | png | name | png reference library licen[cs]e
wtfpl | fuck | text | do what the fuck you want to
wtfpl | wtfpl | hint | wtfpl
ofl-1.1 | sil | name | sil open font licen[cs]e(?:,? version 1\.1)?
ofl-1.1 | ofl | url | scripts\.sil\.org/ofl
ofl-any | ofl | hint | open font licen[cs]e \(ofl\)
odbl-1.0 | database | name | open (?:data commons open )?database licen[cs]e
odc-by-1.0 | commons | name | open data commons attribution licen[cs]e
pddl-1.0 | commons | name | open data commons public domain dedication
odbl-1.0 | opendatacommons | url | opendatacommons\.org/licenses/odbl
ogl-3.0 | government | name | open government licen[cs]e(?: v3\.0)?
cdla-permissive-2.0 | community | name | community data licen[cs]e agreement[ -–]{1,4}permissive
cdla-sharing-1.0 | community | name | community data licen[cs]e agreement[ -–]{1,4}sharing
psf-2.0 | psf | name | psf licen[cs]e(?: agreement)?
psf-2.0 | python | name | python software foundation licen[cs]e(?: agreement)?
psf-2.0 | python | url | docs\.python\.org/3/license
ruby | ruby | name | ruby licen[cs]e
ruby | ruby | text | under the (?:same )?terms (?:as|of) ruby
php-3.01 | php | name | php licen[cs]e,?(?: version)? 3\.01
php-3.01 | php | url | php\.net/license
postgresql | postgresql | name | postgresql licen[cs]e
openssl | openssl | name | openssl licen[cs]e
openssl | openssl | text | this product includes software developed by the openssl project
ssleay | ssleay | name | original ssleay licen[cs]e
curl | curl | name | curl licen[cs]e
vim | vim | name | vim licen[cs]e
w3c | w3c | name | w3c(?:®)? software (?:notice and )?licen[cs]e
ncsa | illinois | name | university of illinois/ncsa open source licen[cs]e
ms-pl | microsoft | name | microsoft public licen[cs]e(?: \(ms-pl\))?
ms-rl | microsoft | name | microsoft reciprocal licen[cs]e(?: \(ms-rl\))?
sspl-1.0 | server | name | server side public licen[cs]e
elastic-2.0 | elastic | name | elastic licen[cs]e(?: 2\.0)?
polyform-nc-1.0.0 | polyform | name | polyform noncommercial licen[cs]e
commons-clause | clause | name | commons clause licen[cs]e condition
upl-1.0 | universal | name | universal permissive licen[cs]e
ecl-2.0 | educational | name | educational community licen[cs]e
afl-3.0 | academic | name | academic free licen[cs]e(?: version| v\.?)? ?3\.0
osl-3.0 | open | name | open software licen[cs]e(?: version| v\.?)? ?3\.0
lppl-1.3c | latex | name | latex project public licen[cs]e
cecill-2.1 | cecill | name | cecill(?:-[bc])?(?: free software)? licen[cs]e
mulanpsl-2.0 | mulan | name | mulan permissive software licen[cs]e
unicode-3.0 | unicode | name | unicode(?:, inc\.)? licen[cs]e(?: agreement)?
zpl-2.1 | zope | name | zope public licen[cs]e
ftl | freetype | name | freetype (?:project )?licen[cs]e
ijg | jpeg | text | this software is based in part on the work of the independent jpeg group
json | evil | text | the software shall be used for good, not evil
beerware | beer | text | you can buy me a beer in return
beerware | beerware | hint | beerware licen[cs]e
beerware | beer | hint | beer-ware licen[cs]e
qpl-1.0 | public | name | q public licen[cs]e
sleepycat | sleepycat | name | sleepycat licen[cs]e
watcom-1.0 | watcom | name | sybase open watcom public licen[cs]e
nasa-1.3 | nasa | name | nasa open source agreement
llama | llama | name | llama [234](?:\.\d)? community licen[cs]e
openrail | open | name | (?:bigscience |creativeml )?open ?rail(?:-[ms]{1,2})?(?: licen[cs]e)?
bigcode-openrail-m | bigcode | name | bigcode open rail-m
proprietary | proprietary | text | proprietary and confidential
proprietary | unauthorized | text | unauthorized (?:copying|use|distribution) of this (?:file|software|material)
proprietary | confidential | hint | this (?:document|file) is confidential
all-rights-reserved | reserved | text | copyright (?:\(c\)|©)? ?(?:\d{4}[-, ]{0,2}){1,8}.{1,60}all rights reserved
all-rights-reserved | reserved | hint | all rights reserved
some-rights-reserved | reserved | hint | some rights reserved
copyright-notice | copyright | hint | copyright (?:\(c\)|©)? ?\d{4}
license-any | license | hint | (?:see|read) the (?:accompanying )?(?:file )?license(?:\.txt|\.md)?
license-any | copying | hint | (?:see|read) the (?:accompanying )?(?:file )?copying(?:\.txt|\.md)?
license-any | licensed | hint | licensed under the [a-z]{2,20} licen[cs]e
"""


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    keyword: str
    kind: str
    pattern: str

    @property
    def tier(self) -> int:
        return KINDS.index(self.kind)


def _compiled(pattern: str) -> str:
    """Whole words only, any case, blanks as gaps."""
    body, inside = [], False
    for k, c in enumerate(pattern):
        if c == "[" and (k == 0 or pattern[k - 1] != "\\"):
            inside = True
        elif c == "]":
            inside = False
        if c == " " and not inside:
            optional = pattern[k + 1 : k + 2] == "?"
            body.append(f"(?:{GAP})" if optional else GAP)
        else:
            body.append(c)
    return f"(?i)(?<![A-Za-z0-9])(?:{''.join(body)})(?![A-Za-z0-9])"


def _tag(name: str) -> str:
    """The identifier in an expression, whole, with a suffix that widens it or not."""
    first = r"^SPDX-License-Identifier:[( \t]*+"
    joined = r"(?<![A-Za-z0-9.+-])(?:AND|OR)[( \t]++"
    return rf"(?i)(?:{first}|{joined}){name}(?:-only|-or-later|\+)?(?![A-Za-z0-9+-]|\.[A-Za-z0-9])"


def rules() -> list[Rule]:
    """All rules in their order: the tags, then the lines above."""
    found = []
    for entry in TAGGED:
        label, name = entry.split(":", 1)
        found.append((label, "spdx", "tag", name))
    for line in LINES.strip().splitlines():
        found.append(tuple(part.strip() for part in line.split(" | ", 3)))
    return [
        Rule(k, label, keyword.replace("\\", ""), kind, (_tag if kind == "tag" else _compiled)(pattern))
        for k, (label, keyword, kind, pattern) in enumerate(found)
    ]
