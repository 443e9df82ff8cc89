"""The list of known licences beside the short texts of ``licenses``: whole texts, standard headers, and digests of long texts.

The digests are of the texts in Debian's /usr/share/common-licenses, normalised as
``licenses.known_digests`` does; those with an appendix after END OF TERMS AND
CONDITIONS also without it, with and without that line.
"""

#: Conditions shared by the BSD licences.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the {} nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.\n"
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE {} AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {} OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, "
    "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means.\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of "
    "our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future "
    "rights to this software under copyright law.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
    "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");'
_APACHE_HEADER = (
    _APACHE + " you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
    "for the specific language governing permissions and limitations under the License."
)
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
    "this file, You can obtain one at {}://mozilla.org/MPL/2.0/."
)
_NAMES = (
    "MIT", "ISC", "0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "CC0-1.0", "Unlicense",
)
_HOLDERS = (("copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"), ("University", "REGENTS", "REGENTS"))
TEXTS: tuple[tuple[str, str], ...] = (
    *[(name, title + text) for _, many, one in _HOLDERS for name, titles, text in (
        ("BSD-2-Clause", ("", "BSD 2-Clause License\n", "The 2-Clause BSD License\n"), _BSD_HEAD + _BSD_TAIL.format(many, one)),
        *[("BSD-3-Clause", ("", "BSD 3-Clause License\n", "The 3-Clause BSD License\n"), _BSD_HEAD + _BSD_THIRD.format(who) + _BSD_TAIL.format(many, one))
          for who in ("copyright holder", "University")],
    ) for title in titles],
    *[("Unlicense", _UNLICENSE + end) for end in (
        "", "\nFor more information, please refer to <https://unlicense.org>", "\nFor more information, please refer to <http://unlicense.org/>")],
    ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + " you may not use this file except in compliance with the License."),
    ("Apache-2.0", _APACHE_HEADER),
    *[("MPL-2.0", _MPL_HEADER.format(scheme)) for scheme in ("http", "https")],
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    *[(name, "SPDX-License-Identifier: " + name) for name in _NAMES],
)
#: license, digest, length and first characters of the normalised text.
DIGESTS: tuple[tuple[str, str, int, str], ...] = (
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b", 9887, "apache license versi"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe", 8871, "apache license versi"),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64", 8843, "apache license versi"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", 5833, "the artistic license"),
    ("CC0-1.0", "6e4a79b7eaf2cdc3879a899ef330c98026c9d697ee87d41a28ac5159e8e53348", 6695, "creative commons leg"),
    ("GFDL-1.2-only", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60", 19583, "gnu free documentati"),
    ("GFDL-1.3-only", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826", 22018, "gnu free documentati"),
    ("GPL-1.0-only", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc", 9415, "gnu general public l"),
    ("GPL-1.0-only", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70", 9387, "gnu general public l"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", 11765, "gnu general public l"),
    ("GPL-2.0-only", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808", 14455, "gnu general public l"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", 17117, "gnu general public l"),
    ("GPL-2.0-only", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", 14483, "gnu general public l"),
    ("GPL-3.0-only", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", 33406, "gnu general public l"),
    ("GPL-3.0-only", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191", 30940, "gnu general public l"),
    ("GPL-3.0-only", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", 30968, "gnu general public l"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", 24130, "gnu library general "),
    ("LGPL-2.0-only", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2", 22249, "gnu library general "),
    ("LGPL-2.0-only", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260", 22277, "gnu library general "),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", 25217, "gnu lesser general p"),
    ("LGPL-2.1-only", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", 23365, "gnu lesser general p"),
    ("LGPL-2.1-only", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df", 23337, "gnu lesser general p"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 7104, "gnu lesser general p"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6", 22447, "mozilla public licen"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", 14341, "mozilla public licen"),
)
