"""Texts that tokenizers treat in special ways."""

import random

ODD_TEXTS = [
    "", " ", "  ", "a", "   a  b ", "\n\n x\ty", "▁ ▁a", "日本語テスト 漢字", "😀😀 é", "a" * 300, " " * 50 + "x", "x" + " " * 37,
    "naïve café Straße", "Hello, world!! 12345 http://a.b/c?d=e", "​﻿ x", "   ,a", "  \n  ",
]
random.seed(1)
ODD_TEXTS += ["".join(random.choice("abe  ▁\n.,日éq😀Thtion") for _ in range(random.randint(1, 40))) for _ in range(500)]
