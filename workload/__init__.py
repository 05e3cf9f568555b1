"""Every operator run over the test tables, with equivalent SQL."""
