"""Files, archives, station lists and topics: readers and writers."""
