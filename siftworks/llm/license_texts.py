"""Public license texts and one-line notices, by SPDX name."""

TEXTS = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """ISC License

Copyright <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
""",
    "0BSD": """Zero-Clause BSD

Copyright (C) <year> by <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
""",
    "BSD-2-Clause": """Copyright (c) <year> <owner>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Zlib": """zlib License

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
""",
}

NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "ISC": "Released under the ISC License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "Zlib": "Released under the zlib License.",
}

# ``licenses.body_digest`` of further published texts, wrapped and with each paragraph on one line, whole and up to the
# end of their terms. The names are of the text, which is the same for "only" and "or later".
DIGESTS = {
    "Apache-2.0": "0ef83cef4a96a0745986bfa775e9101b 68ea26705ce7ed50f4a8ba9e312a0f43 9b5caf54d392f899abe58a07a6089d23",
    "BSD-3-Clause": "dfd9463b7bcad50bb1270be3d6bf0c2a",
    "CC0-1.0": "93a180096f6cfcf2c0dd24f75c2eec48",
    "GFDL-1.2": "3fd7564fae8e9870c49a2b6749a4686c c969fdb4b731dadf7173c1ffbe49a117",
    "GFDL-1.3": "a5eac5dd01441a89eba8fc8853145b0a eb6b86c0fad89753a5a36c484fa0ada2",
    "GPL-1.0": "21fa8693acc5194a648fe02e11f65a72 3aecf3f85b2a7e1cf719c688a1c214fa 738cc3b112640d95d4cd79a58967ecea bbc56cff7140c8c3cd4b868fb25de455 dbf3c47f5a8f127e58d08cabc1ebb916 ed18f57e6f8be34d9ff1e08bcf9104cb",
    "GPL-2.0": "5e39ace6e62f5a7fe9c17b4da986ad8c 68380dbeadb093b94ecf563db7312db7 87c1ab3e4b266c98ddc0fafc9e827ec1 b8444fd08fb20cd8d245a1c56739b50b c87461d4dc2703de84305277d25c82d8 f2c06efe640b4a281cbe5337cdde80ab",
    "GPL-3.0": "17e434cc6db7003444b088cb4cc81e91 2ae5765f3e9def05b0d98370c5a5657d 444f95dc767ede978b60cfb20fbd0bca 5eaa767cc0a56c87c3852144458a3bf1 bd6f8bc415c5aa9e7c23dc0e19215f22 f658e875d8d139792f31fecf68fd1a58",
    "ISC": "835e051a8d57ded2593a1855767e769c",
    "LGPL-2.0": "53c7c83fea2ab2dfecbf363917d53a22 65f359e639bdee839cb4bef5e2e86d5d 74cf7fcef3b29a39165a795b2cad3a3a 97832943be1e344d51af5aee1b658e4f 999f5b95aaa9362eae0bf3cb0eb7581c c396ba2f94537628797123bc12cd2d6e",
    "LGPL-2.1": "3054b3781b1af43f906dc753acad15ee 940870bf133cfca37ab654966cecabe4 a40966c05dddcd43bfccd88fd4e2cfe7 b438fe0ce082f3615cf69a492dbc792f eaf6afb73fc860a002bfbccbe6f07ce7 f998bc436710cfece156aaa84fd26dd4",
    "LGPL-3.0": "087dc82eb7c367aa4297b1f0bb1c2c21 b31b7335bc37919e8cdd79154e04d88d",
    "MPL-1.1": "457c652e259243fa134183fe4d5a487a 4eef16c55a83fc70ca486efa7974a511",
    "MPL-2.0": "ee1ab3f2f76b374732d278225dadce8d",
    "Unlicense": "d8277de56acf642abb71da243c0bc00c",
}
