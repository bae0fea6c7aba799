"""Operators for building training corpora, each in a module of its own."""

from labelloom.shared import ship_package

ship_package()
