"""Brute-force ROC AUC (pairwise, ties count 1/2) used as a reference in tests."""
import numpy as np


def auc_reference(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y != 1]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))
