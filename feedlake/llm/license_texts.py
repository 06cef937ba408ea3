"""Licence wordings to look for."""

# Public licence notices and texts, in their published wording.


def _gnu(licence: str, version: str, work: str = "program") -> str:
    return (f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
            f"version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {licence} for more details.")


#: Creative Commons variants with their names in notices.
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring "
                      "rights to this work.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
           "conditions: The above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
           "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
           "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
           "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
           "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                        "License, or (at your option) any later version. This program is distributed in the hope that it "
                        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
                        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
           "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
           "WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met: 1. Redistributions of source code must retain the above "
                    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
                    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                    "in the documentation and/or other materials provided with the distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met: 1. Redistributions of source code must retain the above "
                    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
                    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                    "in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
                    "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                    "from this software without specific prior written permission.",
    "GPL-2.0-or-later": _gnu("General Public License", "2"),
    "LGPL-2.1-or-later": _gnu("Lesser General Public License", "2.1", "library"),
    "LGPL-3.0-or-later": _gnu("Lesser General Public License", "3"),
    "AGPL-3.0-or-later": _gnu("Affero General Public License", "3"),
}
# BY-NC's short wording stands above
TEMPLATES |= {f"CC-{kind}-4.0-short-notice": f"Licensed under CC {kind} 4.0." for kind in CREATIVE_COMMONS if kind != "BY-NC"}
TEMPLATES |= {f"CC-{kind}-4.0-" + ("long-notice" if kind == "BY-NC" else "notice"):
              f"This work is licensed under a Creative Commons {spelt} 4.0 International License."
              for kind, spelt in CREATIVE_COMMONS.items()}
