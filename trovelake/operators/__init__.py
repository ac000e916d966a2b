"""Operations on a catalogue: search, listing, change, transfer, named SQL."""
