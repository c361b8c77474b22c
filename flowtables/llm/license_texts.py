"""Full licence texts and clauses of long licences, held against windows of a text (operator 7).

Of licences of thousands of words a clause stands for the whole.
"""

# Public licence texts, (name, text).
LONG_TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE "
        "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "apache-2.0",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor "
        "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
        "sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    (
        "apache-2.0",
        "Grant of Patent License. Subject to the terms and conditions of this License, each Contributor "
        "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "(except as stated in this section) patent license to make, have made, use, offer to sell, sell, "
        "import, and otherwise transfer the Work, where such license applies only to those patent claims "
        "licensable by such Contributor that are necessarily infringed by their Contribution(s) alone or by "
        "combination of their Contribution(s) with the Work to which such Contribution(s) was submitted. If "
        "You institute patent litigation against any entity (including a cross-claim or counterclaim in a "
        "lawsuit) alleging that the Work or a Contribution incorporated within the Work constitutes direct or "
        "contributory patent infringement, then any patent licenses granted to You under this License for "
        "that Work shall terminate as of the date such litigation is filed.",
    ),
    (
        "gpl-3.0",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. "
        "The licenses for most software and other practical works are designed to take away your freedom to "
        "share and change the works. By contrast, the GNU General Public License is intended to guarantee "
        "your freedom to share and change all versions of a program--to make sure it remains free software "
        "for all its users. We, the Free Software Foundation, use the GNU General Public License for most of "
        "our software; it applies also to any other work released this way by its authors. You can apply it "
        "to your programs, too.",
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "gpl-2.0",
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users. This General Public License "
        "applies to most of the Free Software Foundation's software and to any other program whose authors "
        "commit to using it. (Some other Free Software Foundation software is covered by the GNU Lesser "
        "General Public License instead.) You can apply it to your programs, too.",
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version. This library is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "mpl-2.0",
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: (a) under "
        "intellectual property rights (other than patent or trademark) Licensable by such Contributor to use, "
        "reproduce, make available, modify, display, perform, distribute, and otherwise exploit its "
        "Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work; and "
        "(b) under Patent Claims of such Contributor to make, use, sell, offer for sale, have made, import, "
        "and otherwise transfer either its Contributions or its Contributor Version.",
    ),
    (
        "cc0-1.0",
        "To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby "
        "overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of "
        "Affirmer's Copyright and Related Rights and associated claims and causes of action, whether now "
        "known or unknown (including existing as well as future claims and causes of action), in the Work (i) "
        "in all territories worldwide, (ii) for the maximum duration provided by applicable law or treaty "
        "(including future time extensions), (iii) in any current or future medium and for any number of "
        "copies, and (iv) for any purpose whatsoever, including without limitation commercial, advertising or "
        "promotional purposes (the Waiver).",
    ),
]
