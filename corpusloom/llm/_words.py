"""The rule for words that several operators share."""

#: Fixed value: a word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
