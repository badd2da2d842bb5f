SF01 = "/root/testdata/sf0.01"
SMOKE = "/root/testdata/sf0.001"
