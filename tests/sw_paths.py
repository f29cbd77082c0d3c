"""Folders the tests share; a module of its own, so that no other conftest can hide it."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
