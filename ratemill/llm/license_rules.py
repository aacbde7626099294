"""Ordered signature rules of licences, hand-written for words in lower case.

A pattern is a line of words. ``[x]`` is an optional word, ``x|y`` a choice of words, and a word may be a regular expression. Each family
gives a rule for every form below; forms of better priority come first, within a form families in their order here.
"""

from __future__ import annotations

import json
import re

# label; keyword of its title; SPDX words; title; words of its address, whose first is the keyword of that form
FAMILIES = """
apache-2.0; apache; apache 2 0; apache [software] license|licence [v|version] [2|v2] [0]; apache org licenses license 2 0
apache-1.1; apache; apache 1 1; apache software license|licence version 1 1; apache org licenses license 1 1
apache-1.0; apache; apache 1 0; apache software license|licence version 1 0; apache org licenses license 1 0
gpl-3.0; gnu; gpl 3 0; gnu general public license|licence [v|version] 3|v3; gnu org licenses gpl 3 0
gpl-2.0; gnu; gpl 2 0; gnu general public license|licence [v|version] 2|v2; gnu org licenses gpl 2 0
gpl-1.0; gnu; gpl 1 0; gnu general public license|licence [v|version] 1|v1; gnu org licenses gpl 1 0
gpl; gnu; gpl; gnu general public license|licence; gnu org licenses gpl
gpl-short-3.0; gplv3; gplv3; [gnu] gplv3; gnu org licenses gpl 3 0 html
gpl-short-2.0; gplv2; gplv2; [gnu] gplv2; gnu org licenses old licenses gpl 2 0
lgpl-3.0; lesser; lgpl 3 0; gnu lesser general public license|licence [v|version] 3|v3; gnu org licenses lgpl 3 0
lgpl-2.1; lesser; lgpl 2 1; gnu lesser general public license|licence [v|version] 2 1; gnu org licenses old licenses lgpl 2 1
lgpl; lesser; lgpl; gnu lesser general public license|licence; gnu org licenses lgpl
lgpl-2.0; library; lgpl 2 0; gnu library general public license|licence [v|version] [2]; gnu org licenses old licenses lgpl 2 0
agpl-3.0; affero; agpl 3 0; gnu affero general public license|licence [v|version] [3|v3]; gnu org licenses agpl 3 0
gfdl-1.3; documentation; gfdl 1 3; gnu free documentation license|licence [v|version] 1 3; gnu org licenses fdl 1 3
gfdl; documentation; gfdl; gnu free documentation license|licence; gnu org licenses fdl
mit; mit; mit; mit [x11|expat] license|licence; opensource org licenses mit
mit-0; mit; mit 0; mit no attribution license|licence; opensource org licenses mit 0
x11; x11; x11; x11 license|licence; opensource org licenses x11
expat; expat; expat; expat license|licence; opensource org licenses expat
isc; isc; isc; isc license|licence; opensource org licenses isc
bsd-2-clause; bsd; bsd 2 clause; 2|two clause bsd license|licence; opensource org licenses bsd 2 clause
bsd-3-clause; bsd; bsd 3 clause; 3|three clause bsd license|licence; opensource org licenses bsd 3 clause
bsd-4-clause; bsd; bsd 4 clause; 4|four clause bsd license|licence; opensource org licenses bsd 4 clause
bsd-simplified; bsd; bsd simplified; simplified|freebsd bsd license|licence; freebsd org copyright bsd license
bsd-new; bsd; bsd new; new|modified|revised bsd license|licence; opensource org licenses bsd license
bsd-0-clause; bsd; 0bsd; zero clause bsd license|licence; opensource org licenses 0bsd
bsd; bsd; bsd; bsd [style] license|licence; opensource org licenses bsd
mpl-2.0; mozilla; mpl 2 0; mozilla public license|licence [v|version] 2|v2 [0]; mozilla org mpl 2 0
mpl-1.1; mozilla; mpl 1 1; mozilla public license|licence [v|version] 1 1; mozilla org mpl 1 1
mpl; mozilla; mpl; mozilla public license|licence; mozilla org mpl
epl-2.0; eclipse; epl 2 0; eclipse public license|licence [v|version] 2|v2 [0]; eclipse org legal epl 2 0
epl-1.0; eclipse; epl 1 0; eclipse public license|licence [v|version] 1|v1 [0]; eclipse org legal epl 1 0
edl-1.0; eclipse; edl 1 0; eclipse distribution license|licence [v|version] [1|v1] [0]; eclipse org org documents edl
cddl-1.0; development; cddl 1 0; common development and distribution license|licence [v|version] [1] [0]; opensource org licenses cddl 1 0
cpl-1.0; common; cpl 1 0; common public license|licence [v|version] [1] [0]; opensource org licenses cpl 1 0
ipl-1.0; ibm; ipl 1 0; ibm public license|licence [v|version] [1] [0]; opensource org licenses ipl 1 0
artistic-2.0; artistic; artistic 2 0; artistic license|licence [v|version] 2 [0]; opensource org licenses artistic 2 0
artistic; artistic; artistic 1 0; artistic license|licence; opensource org licenses artistic
zlib; zlib; zlib; zlib [libpng] license|licence; opensource org licenses zlib
libpng; libpng; libpng; libpng license|licence; libpng org pub png src libpng license
boost-1.0; boost; bsl 1 0; boost software license|licence [v|version] [1] [0]; boost org license 1 0
unlicense; unlicense; unlicense; the unlicense; unlicense org
wtfpl; want; wtfpl; do what the f[a-z]+ you want to public license|licence; wtfpl net
ms-pl; microsoft; ms pl; microsoft public license|licence; microsoft com opensource licenses
ms-rl; microsoft; ms rl; microsoft reciprocal license|licence; microsoft com opensource reciprocal
python-2.0; python; python 2 0; python software foundation license|licence [v|version] [2]; docs python org license
php-3.01; php; php 3 01; php license|licence [v|version] [3] [01]; php net license
ruby; ruby; ruby; ruby license|licence; ruby lang org license
perl; perl; perl; same terms as perl [itself]; dev perl org licenses
postgresql; postgresql; postgresql; postgresql license|licence; postgresql org about licence
openssl; openssl; openssl; openssl license|licence; openssl org source license
ofl-1.1; sil; ofl 1 1; sil open font license|licence [v|version] [1] [1]; openfontlicense org
odbl-1.0; database; odbl 1 0; open [data] [commons] open database license|licence [v|version] [1|v1] [0]; opendatacommons org licenses odbl
odc-by; attribution; odc by 1 0; open data commons attribution license|licence; opendatacommons org licenses by
pddl-1.0; domain; pddl 1 0; public domain dedication and license|licence; opendatacommons org licenses pddl
eupl-1.2; european; eupl 1 2; european union public license|licence [v|version] [1] [2]; joinup ec europa eu collection eupl
cecill; cecill; cecill 2 1; cecill [free] [software] license|licence; cecill info licences
ncsa; ncsa; ncsa; [university] [of] [illinois] ncsa open source license|licence; opensource org licenses ncsa
cc0-1.0; zero; cc0 1 0; creative commons zero [v|version] [1|v1] [0]; creativecommons org publicdomain zero
cc-by-nc-nd; cc; cc by nc nd; cc by nc nd [1-4] [0]; creativecommons org licenses by nc nd
cc-by-nc-sa; cc; cc by nc sa; cc by nc sa [1-4] [0]; creativecommons org licenses by nc sa
cc-by-nc; cc; cc by nc; cc by nc [1-4] [0]; creativecommons org licenses by nc
cc-by-nd; cc; cc by nd; cc by nd [1-4] [0]; creativecommons org licenses by nd
cc-by-sa; cc; cc by sa; cc by sa [1-4] [0]; creativecommons org licenses by sa
cc-by; cc; cc by; cc by [1-4] [0]; creativecommons org licenses by
creative-commons; creative; creative commons; creative commons [attribution] [noncommercial] [sharealike|noderivatives] license|licence; creativecommons org licenses
proprietary; rights; proprietary; all rights reserved; rights reserved worldwide license
public-domain; domain; public domain; public domain; creativecommons org publicdomain mark licenses
"""

# priority; form; weight. A grant names the licence that applies; a title may only be mentioned.
FORMS = [
    (1, "spdx license identifier {spdx}", 1.0),
    (2, "licensed|released|distributed|available|published|provided under|by [the|a] [terms] [of] [the] [conditions] [of] [the] {title}", 0.95),
    (2, "[http|https] [www] {address}", 0.9),
    (3, "{title}", 0.7),
]
# Of the keyword's rules only such texts are looked at, which have one of these words or word starts.
ANCHORS = ["licen", "spdx", "commons", " cc by ", " rights reserved ", " public domain ", "gpl", " wtfpl ", " same terms as perl ", " mpl ", " epl ", " edl ", " eupl ", " opensource ", " publicdomain "]
# The phrases and labels that count as places.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]


def tagged(pattern: str) -> str:
    """A regular expression over words that carry their number, as ``word@3 ``."""
    out = []
    for word in re.sub(r"\[1-4\]", "[1|2|3|4]", pattern).split():
        optional = re.fullmatch(r"\[(\S+\|\S+|[a-z0-9]+)\]", word)
        one = rf"(?:{optional[1] if optional else word})@\d+ "
        out.append(f"(?:{one})?" if optional else one)
    return "(?<= )" + "".join(out)


def rules() -> list[dict]:
    families = [[x.strip() for x in line.split(";")] for line in FAMILIES.strip().splitlines()]
    out = []
    for priority, form, weight in FORMS:
        for label, keyword, spdx, title, address in families:
            pattern = form.format(spdx=spdx, title=title, address=address)
            needed = "spdx" if "{spdx}" in form else address.split()[0] if "{address}" in form else keyword
            out.append({"rank": len(out), "priority": priority, "label": label, "weight": weight, "keyword": needed, "pattern": tagged(pattern)})
    return out


def rules_json() -> str:
    return json.dumps(rules())
