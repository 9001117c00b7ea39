"""Wordings of public licences and of the notices that refer to them, without names and years of holders.

A template is (label, text, mandatory phrases). Case and punctuation don't matter, words do.
"""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so"
)
_MIT_CONDITION = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software."
)
_MIT_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: "
)
_BSD_SOURCE = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. "
)
_BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_BSD_NO_PATENTS = (
    "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_GNU_TERMS = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation; either version {version} of the License, or (at your option) any later version. This program "
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_CC = "This work is licensed under a Creative Commons {name} International License."

#: Licences, most of them whole; of a few (such as ms-pl, postgresql, bsl-1.0) the leading part.
BODIES = [
    ("mit", _MIT_GRANT + _MIT_CONDITION + _MIT_WARRANTY, ["permission is hereby granted", "this permission notice shall be included"]),
    ("mit-0", _MIT_GRANT + "." + _MIT_WARRANTY, ["permission is hereby granted", "furnished to do so the software is provided"]),
    ("json", _MIT_GRANT + _MIT_CONDITION + " The Software shall be used for Good, not Evil." + _MIT_WARRANTY,
     ["permission is hereby granted", "used for good not evil"]),
    ("x11", _MIT_GRANT + _MIT_CONDITION + _MIT_WARRANTY
     + " Except as contained in this notice, the name of the copyright holder shall not be used in advertising or otherwise to "
       "promote the sale, use or other dealings in this Software without prior written authorization from the copyright holder.",
     ["permission is hereby granted", "promote the sale use or other dealings"]),
    ("ncsa", _MIT_GRANT.replace("deal in", "deal with") + ", subject to the following conditions: " + _BSD_SOURCE + _BSD_BINARY
     + "Neither the names of the development group nor the names of its contributors may be used to endorse or promote products "
       "derived from this Software without specific prior written permission." + _MIT_WARRANTY,
     ["permission is hereby granted", "endorse or promote products"]),
    ("bsd-1-clause", _BSD_GRANT + _BSD_SOURCE + _BSD_WARRANTY, ["redistributions of source code", "even if advised of the possibility"]),
    ("bsd-2-clause", _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_WARRANTY,
     ["redistributions of source code", "redistributions in binary form", "even if advised of the possibility"]),
    ("bsd-3-clause", _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_WARRANTY,
     ["redistributions in binary form", "endorse or promote products", "even if advised of the possibility"]),
    ("bsd-3-clause-clear", _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_NO_PATENTS + _BSD_WARRANTY,
     ["redistributions in binary form", "patent rights are granted by this license"]),
    ("bsd-4-clause", _BSD_GRANT + _BSD_SOURCE + _BSD_BINARY + _BSD_ADVERTISING + _BSD_NAMES + _BSD_WARRANTY,
     ["redistributions in binary form", "all advertising materials mentioning features"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies." + _ISC_WARRANTY,
     ["with or without fee", "this permission notice appear in all copies"]),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
     + _ISC_WARRANTY, ["with or without fee is hereby granted the software is provided"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
             "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
             "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
             "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
             "distribution.", ["must not be misrepresented", "may not be removed or altered"]),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
                "to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
                "and this entire statement, including the above license grant, this restriction and the following disclaimer, "
                "must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
                "unless such copies or derivative works are solely in the form of machine-executable object code generated by a "
                "source language processor.", ["person or organization obtaining a copy", "machine executable object code"]),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
                  "author or authors of this software dedicate any and all copyright interest in the software to the public "
                  "domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
                  "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
                  "future rights to this software under copyright law.",
     ["free and unencumbered software", "relinquishment in perpetuity"]),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE. Everyone is permitted to copy and distribute verbatim or modified copies of "
              "this license document, and changing it is allowed as long as the name is changed. TERMS AND CONDITIONS FOR COPYING, "
              "DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.", ["what the fuck you want to public license"]),
    ("postgresql", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and "
                   "without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and "
                   "the following two paragraphs appear in all copies.",
     ["without a written agreement", "following two paragraphs appear"]),
    ("hpnd", "Permission to use, copy, modify and distribute this software and its documentation for any purpose and without fee is hereby "
             "granted, provided that the above copyright notice appear in all copies, and that both that copyright notice and this "
             "permission notice appear in supporting documentation, and that the name of the copyright holder not be used in "
             "advertising or publicity pertaining to distribution of the software without specific, written prior permission.",
     ["appear in supporting documentation", "publicity pertaining to distribution"]),
    ("ntp", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice appears in all copies and that both the copyright notice and "
            "this permission notice appear in supporting documentation, and that the name not be used in advertising or publicity "
            "pertaining to distribution of the software without specific, written prior permission. The suitability of this "
            "software for any purpose is not represented. It is provided \"as is\" without express or implied warranty.",
     ["with or without fee", "appear in supporting documentation"]),
    ("curl", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided "
             "that the above copyright notice and this permission notice appear in all copies." + _MIT_WARRANTY
     + " Except as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote "
       "the sale, use or other dealings in this Software without prior written authorization of the copyright holder.",
     ["with or without fee", "promote the sale use or other dealings"]),
    ("fsfap", "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided "
              "the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.",
     ["in any medium without royalty"]),
    ("fsfullr", "This file is free software; the Free Software Foundation gives unlimited permission to copy and/or distribute it, with or "
                "without modifications, as long as this notice is preserved.", ["gives unlimited permission to copy"]),
    ("beerware", "As long as you retain this notice you can do whatever you want with this stuff. If we meet some day, and you think this "
                 "stuff is worth it, you can buy me a beer in return.", ["buy me a beer"]),
    ("fair", "Usage of the works is permitted provided that this instrument is retained with the works, so that any entity that uses the "
             "works is notified of this instrument. DISCLAIMER: THE WORKS ARE WITHOUT WARRANTY.", ["this instrument is retained"]),
    ("cc0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
                "neighboring rights to this work.", ["waived all copyright and related or neighboring rights"]),
    ("ms-pl", "If you use the software, you accept this license. If you do not accept the license, do not use the software. The terms "
              "reproduce, reproduction, derivative works, and distribution have the same meaning here as under U.S. copyright law.",
     ["if you use the software you accept this license"]),
]

#: Notices that stand for a licence kept elsewhere.
NOTICES = [
    ("mit", "released under the MIT license", ["mit license"]),
    ("mit", _MIT_GRANT, ["permission is hereby granted", "without restriction"]),
    ("mit", "licensed under the MIT license", ["mit license"]),
    ("apache-2.0", "licensed under the Apache License, version 2.0", ["apache license", "version 2"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
                   "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License.", ["apache license", "as is basis"]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "as is basis, without warranties or conditions of any kind, either express or implied",
     ["as is basis", "without warranties or conditions"]),
    ("bsd-3-clause", _BSD_NAMES, ["endorse or promote products", "prior written permission"]),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee", "this permission notice appear in all copies"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ["cc by nc", "4 0"]),
    ("cc-by-4.0", _CC.format(name="Attribution 4.0"), ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", _CC.format(name="Attribution-ShareAlike 4.0"), ["attribution sharealike 4 0"]),
    ("cc-by-nc-4.0", _CC.format(name="Attribution-NonCommercial 4.0"), ["attribution noncommercial 4 0"]),
    ("cc-by-nd-4.0", _CC.format(name="Attribution-NoDerivatives 4.0"), ["attribution noderivatives 4 0"]),
    ("gpl-3.0", "this work is licensed under the GNU General Public License version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "this work is licensed under the GNU General Public License version 2", ["gnu general public license", "version 2"]),
    ("gpl", "this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation", ["gnu general public license", "free software foundation"]),
    ("gpl-2.0", _GNU_TERMS.format(name="General Public License", version="2"), ["gnu general public license", "version 2"]),
    ("gpl-3.0", _GNU_TERMS.format(name="General Public License", version="3"), ["gnu general public license", "version 3"]),
    ("lgpl-2.1", _GNU_TERMS.format(name="Lesser General Public License", version="2.1"), ["lesser general public license", "version 2 1"]),
    ("lgpl-3.0", _GNU_TERMS.format(name="Lesser General Public License", version="3"), ["lesser general public license", "version 3"]),
    ("agpl-3.0", _GNU_TERMS.format(name="Affero General Public License", version="3"), ["affero general public license", "version 3"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["mozilla public license", "2 0"]),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
     ["eclipse public license", "2 0"]),
    ("cddl-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License",
     ["common development and distribution license"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0.", ["boost software license"]),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", ["governed by a bsd style license"]),
    ("artistic-2.0", "This is free software; you may redistribute it and/or modify it under the terms of the Artistic License 2.0.",
     ["artistic license 2 0"]),
    ("eupl-1.2", "Licensed under the European Union Public Licence, version 1.2", ["european union public licence"]),
]

TEMPLATES = NOTICES + BODIES
