"""Public license notices. Notices that differ in few words are there together, so that each finds its own."""

from __future__ import annotations

_PLAIN = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                         "the License. You may obtain a copy of the License at",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                          "following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "bsd-2-clause-short": "Released under the BSD 2-Clause License.",
    "bsd-3-clause-short": "Released under the BSD 3-Clause License.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
               "documentation covered by this license",
    "cc0-1.0": "has waived all copyright and related or neighboring rights to",
    "cddl-1.0": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may "
                "not use this file except in compliance with the License. You can obtain a copy of the License at",
    "ecl-2.0-header": "Licensed under the Educational Community License, Version 2.0 (the \"License\"); you may not use this file except in "
                      "compliance with the License. You may obtain a copy of the License at",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
           "the above copyright notice and this permission notice appear in all copies.",
    "isc-short": "Released under the ISC License.",
    "mit-0-short": "Released under the MIT-0 License.",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
               "this file, You can obtain one at",
    "mpl-2.0-short": "This work is licensed under the Mozilla Public License, version 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                 "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                 "non-commercial, and by any means.",
    "unlicense-short": "Released under the Unlicense.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
            "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
            "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}

_GNU = [("gpl", "General", v) for v in ("1", "2", "3")] + [("lgpl", "Library General", "2"), ("lgpl", "Lesser General", "2.1"),
        ("lgpl", "Lesser General", "3"), ("agpl", "Affero General", "1"), ("agpl", "Affero General", "3")]
_CC = {"by": "", "by-sa": "-ShareAlike", "by-nc": "-NonCommercial", "by-nd": "-NoDerivatives", "by-nc-sa": "-NonCommercial-ShareAlike",
       "by-nc-nd": "-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}

_MIT_RIGHTS = (_PLAIN["mit-grant"] + " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
               "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
               "furnished to do so")
_MIT_NOTICE = (", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
               "substantial portions of the Software.")
_MIT_WARRANTY = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                 "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_BSD_SOURCE = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
               "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
               "documentation and/or other materials provided with the distribution.")
_BSD_ADVERT = (" 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
               "includes software developed by")
_BSD_NAME = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission.")
_BSD_WARRANTY = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
                 "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")


def _gnu():
    for short, kind, v in _GNU:
        name = f"{short}-{v if '.' in v else v + '.0'}"
        work = "library" if short == "lgpl" and v != "3" else "program"
        published = f"as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
        yield name, f"This work is licensed under the GNU {kind} Public License, version {v}."
        yield f"{name}-header", f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License {published}"
        yield f"{name}-only-header", (f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License "
                                      f"version {v} as published by the Free Software Foundation.")


def _cc():
    for kind, parts in _CC.items():
        for v, realm in _CC_VERSIONS.items():
            name = f"cc-{kind}-{v}"
            title = f"Attribution{parts if v == '4.0' else parts.replace('NoDerivatives', 'NoDerivs')}"
            yield f"{name}-notice", f"This work is licensed under a Creative Commons {title} {v} {realm} License."
            yield f"{name}-short", f"Licensed under CC {kind.upper()} {v}."


def _long():
    bsd = _PLAIN["bsd-redistribution"] + _BSD_SOURCE
    yield "bsd-2-clause", bsd + _BSD_WARRANTY
    yield "bsd-3-clause", bsd + " 3." + _BSD_NAME + _BSD_WARRANTY
    yield "bsd-4-clause", bsd + _BSD_ADVERT + " 4." + _BSD_NAME + _BSD_WARRANTY
    yield "json", _MIT_RIGHTS + _MIT_NOTICE + " The Software shall be used for Good, not Evil." + _MIT_WARRANTY
    yield "mit-0", _MIT_RIGHTS + "." + _MIT_WARRANTY
    yield "mit-text", _MIT_RIGHTS + _MIT_NOTICE + _MIT_WARRANTY


TEMPLATES = dict(_PLAIN)
for _name, _text in (*_gnu(), *_cc(), *_long()):
    if _text not in _PLAIN.values():  # a notice has one name
        TEMPLATES[_name] = _text
