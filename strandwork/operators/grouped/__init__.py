"""Order-dependent sequence algorithms: plain functions on one group's rows, and the grouped maps that apply them.

A group is one gene's (or one taxon's or read's) rows; every function sorts its input by a total order first, so results do not
depend on how rows were dealt.
"""
