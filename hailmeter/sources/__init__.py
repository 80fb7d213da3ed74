"""Landing-zone readers, load reports and table writers."""
