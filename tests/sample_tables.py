"""Where the smallest shared tables lie."""

SF0001 = "/root/testdata/sf0.001"
