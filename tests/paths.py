"""Folders the tests read."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
